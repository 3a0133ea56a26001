"""Which contexts the suffix tree keeps: the divergence test restated plainly, and growth with the corpus."""

import math
import random
from collections import Counter, defaultdict

from conftest_llm import sentence
from traitmatch.llm import suffix_lm as lm
from traitmatch.llm.contexts import PAD


def plain_kept(texts, gain):
    counts, positions = defaultdict(Counter), 0
    for text in texts:
        data = PAD + b" ".join(lm.words_of(text)) + lm.END
        for p in range(len(PAD), len(data)):
            positions += 1
            for k in range(lm.DEPTH + 1):
                counts[data[p - k:p]][data[p]] += 1
    least, kept = gain * math.sqrt(positions), {b""}
    for context, cells in counts.items():
        if not context:
            continue
        n, suffix = sum(cells.values()), counts[context[1:]]
        m = sum(suffix.values())
        saved = sum(c * math.log((c / n) / (suffix[s] / m)) for s, c in cells.items())
        if saved >= least:
            kept.add(context)
    return kept, counts


def grams(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return lm.corpus_counts(df).filter("kind = 1")


def test_kept_contexts_equal_a_plain_restatement(spark):
    rng = random.Random(1)
    texts = [sentence(rng, rng.randint(1, 60)) for _ in range(60)] + ["", None, "ab" * 300, "漢字 🙂"]
    for gain in (0.05, 0.5):
        want, counts = plain_kept(texts, gain)
        got = lm.context_counts(grams(spark, texts), gain)
        assert set(got) == want and len(want) > 5
        assert all(got[c] == dict(counts[c]) for c in want)


def test_the_tree_grows_with_the_corpus_but_keeps_its_bound(spark):
    rng = random.Random(2)
    texts = [sentence(rng, 40) for _ in range(400)]
    sizes = []
    for n in (25, 100, 400):
        some = grams(spark, texts[:n])
        positions = some.agg({"n": "sum"}).first()[0]
        sizes.append(lm.kept_contexts(some).count())
        assert sizes[-1] <= 1 + lm.DEPTH * lm.MOST_NATS / lm.GAIN * math.sqrt(positions)
    assert sizes[0] < sizes[1] < sizes[2]


def test_no_contexts_without_text(spark):
    assert lm.kept_contexts(grams(spark, ["x"]).limit(0)).count() == 0
    assert set(lm.context_counts(grams(spark, [None]))) >= {b""}
