"""Joins, models, audits and the pipeline on small fixtures, against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import fold, sentence
from traitmatch.llm import components, contamination as co, fixity, jaccard as ja, langid, quality_model as qm
from traitmatch.llm import suffix_lm as lm


# --- Jaccard join ---

def plain_sets(texts):
    out = []
    for _, t in texts:
        w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out.append({tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    return out


def plain_components(texts):
    sets, ids = plain_sets(texts), [i for i, _ in texts]
    at = list(range(len(texts)))

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if (sets[i] and 100 * both >= 90 * len(sets[i] | sets[j])) or (ids[i] is not None and ids[i] == ids[j]):
                at[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[root(i)] = min(x, least.get(root(i), x))
    return sorted(((ids[i], len(sets[i]), least.get(root(i)) if sets[i] else ids[i]) for i in range(len(texts))), key=repr)


def components_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_shingles", "component_id")) for r in df.collect()), key=repr)


@pytest.mark.parametrize("group_shingles", [ja.GROUP_SHINGLES, 100])      # whole groups, and many blocks
def test_jaccard_components(docs, texts, group_shingles):
    assert components_of(ja.jaccard_components(docs, group_shingles=group_shingles)) == plain_components(texts)


def test_near_copies_at_the_threshold(spark):
    rng = random.Random(3)
    rows, n = [], 0
    for size in (11, 12, 20, 31, 48, 100, 250, 700):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for edits in (0, 1, 2, 3, 4, 6, 9):
            changed = list(words)
            for k in rng.sample(range(size), min(edits, size)):
                changed[k] = f"v{n}x{k}"
            rows += [(n, " ".join(changed)), (n + 1, " ".join(changed + ["tail"] * (edits % 3)))]
            n += 2
    got = components_of(ja.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert got == plain_components(rows)


def near_copies(rng, first, copies, size=120):
    """Copies of one text, each with one of its words changed."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for n in range(first, first + copies):
        changed = list(words)
        changed[rng.randrange(size)] = f"v{n}"
        out.append((n, " ".join(changed)))
    return out


def test_a_large_class_is_not_paired_with_itself(spark):
    rng = random.Random(11)
    rows = near_copies(rng, 0, 400) + near_copies(rng, 1000, 60)
    rows += [(2000 + i, rows[i][1] + " " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(20))) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    size = 2000                                   # about 17 texts: the large class has some 47 blocks
    assert components_of(ja.jaccard_components(docs, group_shingles=size)) == plain_components(rows)

    sets = ja.shingle_sets(docs)
    edges = ja.candidate_edges(sets)
    large = (components.connected_components(edges).withColumnRenamed("node", "doc_id")
             .join(sets.select("doc_id", "set_hash", "n_shingles"), "doc_id"))
    lead = ja.leader_rows(large, edges, size)
    assert lead.count() <= 1.5 * len(rows)
    classes = components.connected_components(ja.links_of_blocks(docs, lead))
    placed = ja.block_rows(large, classes, size)
    # all pairs of blocks would be some 50 rows a text
    assert placed.count() <= 4 * len(rows)
    most = placed.groupBy("component", "i", "j").count().agg({"count": "max"}).first()[0]
    assert most <= 4 * size / 110


def test_an_empty_block_is_paired_with_nothing(spark):
    some = [np.arange(k, k + 20, dtype=np.uint64) for k in range(3)]
    assert ja.tree_join(some, []) == [] and ja.tree_join([], some) == [] and ja.tree_join([], []) == []

    # one class above half the limit and two pooled ones: two pooled blocks, both classes in one of them
    size, rng = 2000, random.Random(13)
    at = {r.id: r.block for r in spark.range(100, 200).select("id", F.pmod(F.xxhash64("id"), F.lit(2)).alias("block")).collect()}
    leads = [i for i in at if at[i] == at[100]][:2]
    rows = {1000: near_copies(rng, 1000, 30)} | {x: near_copies(rng, 2000 + 10 * k, 5) for k, x in enumerate(leads)}
    classes = spark.createDataFrame([(i, x) for x, texts in rows.items() for i, _ in texts], "node bigint, component bigint")
    docs = spark.createDataFrame([r for texts in rows.values() for r in texts], "doc_id bigint, text string")
    large = ja.shingle_sets(docs).select("doc_id", "set_hash", "n_shingles", F.lit(1).cast("bigint").alias("component"))
    placed = ja.block_rows(large, classes, size)
    blocks = {r.block for r in placed.collect()}
    assert len([b for b in blocks if b.startswith("pool")]) == 1
    assert {b for r in placed.collect() for b in (r.i, r.j)} == blocks
    assert ja.links_of_blocks(docs, placed).count() == 0              # the classes are connected already


def test_one_row_of_each_component_stays_whatever_its_id(spark):
    rng = random.Random(21)
    a, b, c, d, e = (sentence(rng, 60) for _ in range(5))
    near = " ".join(["x"] + b.split()[1:])
    rows = [(1, a, 0), (None, a, 1), (None, b, 2), (None, b, 3), (None, near, 4), (None, c, 5), (7, d, 6), (7, d, 7),
            (7, e, 8), (3, d, 9), (None, "", 10), (None, None, 11), (9, "", 12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, at int")
    out = ja.keep_one_per_component(docs)
    assert out.columns == docs.columns
    got = sorted(r["at"] for r in out.collect())
    assert got == [0, 2, 5, 8, 9, 10, 11, 12]
    assert ja.keep_one_per_component(docs.limit(0)).count() == 0


def test_signatures_never_lose_a_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(9, 400))
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        drop, add = int(rng.integers(0, n // 9 + 1)), int(rng.integers(0, n // 9 + 1))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)]))
        a = np.unique(a)
        if ja.linked(a, b) and not np.array_equal(a, b):
            assert np.intersect1d(ja.signatures(a), ja.signatures(b)).size


def test_tree_join_finds_the_components_of_all_links():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(25):
        base = rng.integers(0, 2**63, int(rng.integers(5, 300)), dtype=np.uint64)
        for _ in range(int(rng.integers(1, 8))):
            keep = rng.random(len(base)) > rng.choice([0.0, 0.02, 0.05, 0.2])
            sets.append(np.unique(base[keep] if keep.any() else base))
    links = {(i, j) for i in range(len(sets)) for j in range(i) if ja.linked(sets[i], sets[j])}

    def classes(pairs):
        at = list(range(len(sets)))
        for i, j in pairs:
            a, b = at[i], at[j]
            at = [a if x == b else x for x in at]
        return {frozenset(k for k in range(len(sets)) if at[k] == x) for x in at}

    assert classes(ja.tree_join(sets)) == classes(links)
    half = len(sets) // 2
    cross = classes(ja.tree_join(sets[:half], sets[half:]))
    assert cross == classes({(i, j) for i, j in links if i >= half > j})


def test_connected_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(50)] + [(7, 7)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    at = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                at[a] = at[b] = min(at[a], at[b])
    assert got == at
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- decontamination ---

def plain_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_contamination(texts, items):
    out = []
    for doc_id, t in texts:
        w, hit, found = plain_words(t), set(), set()
        for item, x in items:
            v = plain_words(x)
            k = min(13, len(v))
            for i in range(len(v) - k + 1) if v and item is not None else ():
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == v[i:i + k]:
                        hit.update(range(p, p + k))
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_contamination(spark, docs, texts, monkeypatch):
    small = [(i, t) for i, t in texts if i not in (509, 510)]
    by = dict(texts)
    items = [(1, by[400]), (2, by[401].upper()), (10, "one TWO"), (9, "One"), (None, by[3]), (4, None), (5, "  "),
             (6, " ".join(by[5].split()[:13])), (7, by[5] + " and more words that never occur"), (1, "one"), (8, by[0])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(r) for r in co.find_contamination(docs.filter("doc_id is null or doc_id not in (509, 510)"), bench).select(COLUMNS).collect()]
    assert sorted(got, key=repr) == plain_contamination(small, items)
    monkeypatch.setattr(co, "BLOCK_WORDS", 50)                     # many query blocks, same answer
    monkeypatch.setattr(co.query_blocks, "__defaults__", (50,))
    again = co.find_contamination(docs.filter("doc_id is null or doc_id not in (509, 510)"), bench).select(COLUMNS)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(got, key=repr)
    kept = co.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id in (400, 401, 503)").count() == 0 and kept.filter("doc_id in (500, 7)").count() == 2


def test_contamination_with_empty_sides(docs, empty, spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert co.find_contamination(docs, none).filter("n_hit > 0 or contaminated").count() == 0
    assert co.find_contamination(docs, none).count() == docs.count()
    assert co.find_contamination(empty, none).count() == 0


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha " + "z " * 30 + "beta gamma"),
                                  (4, "alpha beta"), (5, "gamma")], "doc_id bigint, text string").coalesce(1)
    index = co.build_index(docs)
    items = spark.createDataFrame([("q", "alpha beta gamma")], "item string, text string")
    number = {r.doc_no: r.doc_id for r in co.index_documents(index).collect()}
    assert {number[r.doc_no] for r in co.search(index, items, span=5).collect()} == {1, 2}
    assert co.search(index, items).count() == 0


# --- models ---

def language_rows(spark, n=120):
    rng = random.Random(4)
    parts = {"en": "the and ing tion of was er th".split(), "de": "sch ung der ein ü ich keit und".split()}
    rows = [(i, "".join(rng.choice(parts[x]) + rng.choice(["", " "]) for _ in range(60)), x)
            for i in range(n) for x in (["en", "de"][i % 2],)]
    rows += [(n, None, "en"), (n + 1, "", "de"), (n + 2, "12 34 !", "en"), (None, "the and of", "en"), (n + 3, "the", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), rows


def test_language_of_held_out_texts(spark):
    df, rows = language_rows(spark)
    got = {r.doc_id: r for r in langid.predict_language(df).collect() if r.doc_id is not None}
    held = [(i, x) for i, t, x in rows if i is not None and i < 120 and fold(i, 4) == 2]
    assert all(got[i].held_out and got[i].lang_pred == x for i, x in held)
    assert {got[i].lang_pred for i in (120, 121, 122)} == {"und"} and all(0 <= r.score <= 1 for r in got.values())
    assert langid.predict_language(df.limit(0)).count() == 0
    nothing = langid.predict_language(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_prediction_reads_only_the_text(spark):
    df, _ = language_rows(spark)
    other = df.withColumn("lang", F.when(langid.remainder(F.col("doc_id"), 4) == 2, F.lit("zz")).otherwise(F.col("lang")))
    key = lambda d: sorted(((r.doc_id, r.lang_pred) for r in d.collect()), key=repr)
    assert key(langid.predict_language(df)) == key(langid.predict_language(other))


def test_any_number_of_labels_is_scored(spark):
    df, rows = language_rows(spark)
    key = lambda d: sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 6), round(r.bits_per_byte, 4))
                            for r in d.collect()), key=repr)
    # noisy labels and other alphabets: the same in blocks of two as in one table
    few = df.unionByName(spark.createDataFrame(
        [(200 + i, t, x) for i, (t, x) in enumerate([("привет мир как дела", "ru"), ("γεια σου κόσμε", "el"),
                                                     ("the and of ing", "EN"), ("12 zażółć gęślą", "pl")] * 8)],
        "doc_id bigint, text string, lang string"))
    whole = key(langid.predict_language(few))
    assert whole == key(langid.predict_language(few, block_langs=2)) == key(langid.predict_language(few, table_bytes=1 << 17))
    assert whole == key(langid.predict_language(few.unionByName(few).unionByName(few).repartition(3)).distinct())
    many = df.unionByName(df.filter("doc_id < 120").select((F.col("doc_id") + 1000).alias("doc_id"), F.lit("zz zz").alias("text"),
                                              F.concat(F.lit("x"), F.col("doc_id").cast("string")).alias("lang")))
    assert many.select("lang").distinct().count() > langid.BLOCK_LANGS + 20
    got = langid.predict_language(many).collect()
    held = {i: x for i, t, x in rows if i is not None and i < 120 and fold(i, 4) == 2}
    assert len(got) == many.count() and all(r.lang_pred == held[r.doc_id] for r in got if r.doc_id in held)


def test_code_lengths_equal_a_plain_walk():
    train = [b"abracadabra abra", b"cadabra bar"]
    model = langid.ContextModels(["x"], [langid.gram_counts(train)])
    counts = {}
    for t in train:
        padded = langid.PAD + t
        for p in range(len(langid.PAD), len(padded)):
            for k in range(4):
                counts.setdefault(padded[p - k:p], Counter())[padded[p]] += 1
    size = model.table.size

    def bits(before, symbol):
        mass, closed = 1.0, set()
        for k in range(3, -1, -1):
            seen = {s: n for s, n in counts.get(before[len(before) - k:], {}).items() if s not in closed}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if symbol in seen:
                return mass * seen[symbol] / total
            mass *= len(seen) / total
            closed |= set(seen)
        return mass / (size - len(closed))

    for text in (b"abra", b"zebra cab", b"\n"):
        padded, want = langid.PAD + text, 0.0
        for p in range(len(langid.PAD), len(padded)):
            want -= math.log2(bits(padded[:p], padded[p] if padded[p] in set(b"".join(train)) | {10} else -1))
        assert model.lengths([text])[0, 0] == pytest.approx(want, rel=1e-4)


def test_base_and_tree_scores(docs, texts, spark):
    rows = {r.doc_id: r for r in lm.score_documents(docs, head=5).collect() if r.doc_id is not None}   # nearly all words joined
    full = {r.doc_id: r for r in lm.score_documents(docs).collect() if r.doc_id is not None}
    train = Counter(w for i, t in texts if i is not None and fold(i, 10) for w in [*lm.words_of(t), b"\n"])
    total, kinds = sum(train.values()), len(train)
    for i, t in texts:
        if i is None:
            continue
        tokens = [*lm.words_of(t), b"\n"]
        want = sum(math.log10((train[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens)
        for r in (rows[i], full[i]):
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(train[w] > 0 for w in tokens), total)
            assert r.base_score == pytest.approx(want) and r.held_out == (fold(i, 10) == 0) and r.score < 0
    assert lm.score_documents(docs.limit(0)).count() == 0
    untrained = lm.score_documents(spark.createDataFrame([(None, "a b")], "doc_id bigint, text string")).first()
    assert (untrained.n_known, untrained.train_tokens, untrained.held_out) == (0, 0, False)


def test_suffix_tree_is_a_distribution_in_every_state():
    counts = {b"": {97: 50, 98: 50, 10: 10}, b"a": {98: 49, 10: 1}, b"b": {97: 45, 10: 5}, b"ab": {97: 40, 98: 5}}
    tree = lm.SuffixTree(counts)
    assert b"a" in tree.probs and all(p.sum() == pytest.approx(1) for p in tree.probs.values())
    # the longest kept suffix decides
    want = sum(math.log10(tree.probs[c][s]) for c, s in ((b"", 97), (b"a", 98), (b"ab" if b"ab" in tree.probs else b"b", 97)))
    assert tree.scores([b"aba"])[0] == pytest.approx(want, rel=1e-5)


def test_quality_model(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 > 0
        text = sentence(rng, 80) if good else " ".join(w + rng.choice(["###", "$$$"]) for w in sentence(rng, 80).split())
        rows.append((i, text))
        if i < 300:
            labels.append((i, int(good)))
    rows += [(1000, None), (1001, ""), (None, "x y")]
    labels += [(None, 1), (3, None), (9999, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = {r.doc_id: r for r in qm.score_quality(docs, marks).collect()}
    held = [i for i in range(300) if fold(i, 5) == 0]
    assert np.mean([got[i].predicted == (i % 4 > 0) for i in held]) > 0.95 and all(got[i].held_out for i in held)
    assert got[1000].score == got[1001].score and all(0 <= r.score <= 1 for r in got.values())
    assert len(got) == len(rows)
    assert {r.score for r in qm.score_quality(docs, marks.limit(0)).collect()} == {0.5}
    assert qm.score_quality(docs.limit(0), marks).count() == 0


# --- fixity ---

def test_audit_finds_exactly_the_damage(spark):
    rows = [(i, f"http://h/{i}", "body " * (i % 50)) for i in range(3000)] + [(5, "http://h/5", "again"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    primary = fixity.catalogue(pages).select("archive", "offset", "length", "page_id", "digest").cache()
    assert fixity.audit(primary, primary).count() == 0
    replica = (primary.filter("page_id is null or page_id <> 77")
               .withColumn("digest", F.when(F.col("page_id") == 1500, F.lit("bad")).otherwise(F.col("digest"))))
    extra = spark.createDataFrame([(2, 10**9, 5, 1, "new")], "archive bigint, offset bigint, length bigint, page_id bigint, digest string")
    found = fixity.audit(primary, replica.unionByName(extra)).collect()
    assert sorted((r.status, r.page_id) for r in found) == [("altered", 1500), ("extra", 1), ("missing", 77)]
    assert all(r.range_start <= r.offset < r.range_end for r in found)
    assert fixity.audit(primary.limit(0), primary.limit(0)).count() == 0


def test_a_lost_or_shortened_record_does_not_move_the_others(spark):
    rng = random.Random(6)
    rows = [(i, f"http://h/{i}", "body " * rng.randrange(1, 50)) for i in range(2500)]
    rows += [(8, "http://h/8", "twice")] * 2 + [(None, "http://h/n", "x"), (3, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    kept = [r for r in rows if r[0] != 4] + [(1200, "http://h/new", "one more")]
    kept = [(i, u, t[:3] if i == 1100 else t + "!" if i == 2000 else t) for i, u, t in kept]
    kept.remove((8, "http://h/8", "twice"))
    replica = fixity.catalogue(spark.createDataFrame(kept, "page_id bigint, url string, html string"))
    found = fixity.audit(fixity.catalogue(pages), replica).collect()
    assert sorted((r.page_id, r.status) for r in found) == [
        (4, "missing"), (8, "missing"), (1100, "altered"), (1200, "extra"), (2000, "altered")]
    at = {(r.page_id, r.digest): r for r in fixity.catalogue(pages).collect()}
    for r in found:
        if r.status != "extra":
            assert (r.offset in {x.offset for k, x in at.items() if k[0] == r.page_id} or r.page_id == 8)
            assert at[(r.page_id, r.primary_digest)].length == r.length
    # the damaged copy is hashed record by record, and none but the damage is told
    copy = fixity.catalogue(fixity.damaged_copy(pages)).collect()
    assert len(copy) == sum(i is None or i % 97 != 64 for i, _, _ in rows)
    told = sorted((r.page_id, r.status) for r in fixity.audit_damaged_copy(pages).collect())
    assert told == sorted((i, "missing" if i % 97 == 64 else "altered") for i, _, _ in rows if i is not None and i % 97 in (5, 31, 64))
    assert {r.length for r in copy if r.page_id == 31} != {r.length for k, r in at.items() if k[0] == 31}


# --- pipeline and registration ---

def test_records_in_another_order_are_told_as_moved(spark):
    pages = spark.range(0, 400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                       F.concat(F.lit("body "), F.col("id") * 7).alias("html"))
    primary = fixity.catalogue(pages).cache()
    size = primary.agg(F.sum("length")).first()[0]
    first = {r.page_id: r.offset for r in primary.collect()}
    ends = {r.page_id: r.offset + r.length for r in primary.collect()}
    # all records in reverse: every range of 64 ids, and the ranges among themselves
    turned = primary.withColumn("offset", F.lit(size) - F.col("offset") - F.col("length"))
    got = {(r.status, r.offset, r.range_end) for r in fixity.audit(primary, turned).collect()}
    assert got == {("moved", 0, size), *(("moved", first[i], ends[min(i + 63, 399)]) for i in range(0, 400, 64))}
    # two neighbours swapped, and one lost record elsewhere: its range is not out of order
    a, b = first[10], first[11]
    swapped = (primary.withColumn("offset", F.when(F.col("page_id") == 10, F.lit(a) + ends[11] - b)
                                  .when(F.col("page_id") == 11, F.lit(a)).otherwise(F.col("offset")))
               .filter("page_id <> 200"))
    rows = fixity.audit(primary, swapped).collect()
    assert sorted((r.status, r.page_id, r.range_start, r.range_end) for r in rows if r.status == "moved") == [("moved", None, 0, ends[63])]
    assert [(r.status, r.page_id) for r in rows if r.status != "moved"] == [("missing", 200)]
    # one record far from its place: the archive's ranges overlap
    far = primary.withColumn("offset", F.when(F.col("page_id") == 63, F.lit(size)).otherwise(F.col("offset")))
    assert [(r.status, r.range_start, r.range_end) for r in fixity.audit(primary, far).collect()] == [("moved", 0, size)]
    assert fixity.audit(primary, primary).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(8)
    item = sentence(rng, 30)
    clean = [sentence(rng, 120) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(50, clean[0]), (51, " ".join(["x"] + clean[1].split()[1:]))]                      # copies
    rows += [(60, sentence(rng, 40) + " " + item + " " + sentence(rng, 40)), (61, "too short"), (62, "spam " * 200), (63, None)]
    rows += [(70, sentence(rng, 100) + ' password = "hunter22x"')]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    import corpus_pipeline

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
    assert sorted(r.doc_id for r in docs.collect()) == [*range(12), 70]
    assert "hunter22x" not in docs.filter("doc_id = 70").first().text
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [*range(12), 70]


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14)) and "pipeline" in names


def test_records_without_id_have_the_offsets_of_one_ordered_archive(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, None, -3, 7, 1500]), f"http://h/{i % 40}", "x" * rng.randrange(50)) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = fixity.catalogue(pages).collect()
    by_archive = {}
    for r in found:
        by_archive.setdefault(r.archive, []).append(r)
    assert len(found) == len(rows) and set(by_archive) == {-1, 0, 1}
    for each in by_archive.values():
        at = 0
        for r in sorted(each, key=lambda r: (r.page_id is not None, r.page_id or 0, r.digest, r.offset)):
            assert r.offset == at
            at += r.length


def test_a_stage_hands_back_its_tables_and_gives_the_same_rows(spark):
    from functools import lru_cache

    from traitmatch.llm import common
    from traitmatch.llm.bpe import encode_documents

    @lru_cache(maxsize=2)
    def table(name):
        return [name]

    def run(batches):
        for b in batches:
            yield table(b)

    assert list(common.tidy(run, [table])(["a", "b"])) == [["a"], ["b"]] and table.cache_info().currsize == 0
    docs = spark.createDataFrame([(1, "some text " * 9), (2, None), (3, ""), (3, "漢字 🙂")], "doc_id bigint, text string")
    plain, staged = (sorted(map(tuple, encode_documents(docs, hand_back=h).collect())) for h in (False, True))
    assert plain == staged and len(plain) == 4
