"""Importance resampling, embedding whitening and toxicity against plain restatements and planted cases."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest_llm import fold, sentence
from traitmatch.llm import resampling as rs, toxicity as tx, whitening as wh

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- importance resampling -----------------------------------------------------------

def plain_resample(docs, target, max_run, buckets, min_words, share):
    def features(text):
        w = WORD.findall(lower(text))
        return [" ".join(w[i:i + n]) for n in range(1, max_run + 1) for i in range(len(w) - n + 1)], len(w)

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for out, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features(text)[0]:
                out[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    made = []
    for doc_id, text in docs:
        found, n_words = features(text)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        made.append([doc_id, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))])
    eligible = sorted((r for r in made if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    drawn = len(eligible) * share // 100
    rank = {id(r): i + 1 for i, r in enumerate(eligible[:drawn])}
    return sorted((tuple(r) + (rank.get(id(r)),) for r in made), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("max_run,head", [(1, 64), (1, 1), (2, 50), (3, 7)])
def test_resampling_equals_a_plain_restatement(spark, docs, texts, max_run, head):
    items = [texts[0][1], texts[44][1], None, "", "Data MODEL 漢字 shard"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id bigint, text string")
    out = rs.resample(docs, target, max_run=max_run, buckets=997, head_words=head, head_pairs=head, min_words=5, share=40)
    assert got(out) == plain_resample(texts, items, max_run, 997, 5, 40)


def test_resampling_contract_features_clashing_names_and_empty_tables(spark, docs, clashing, empty, texts):
    target = spark.createDataFrame([(1, "data model corpus data")], "item_id bigint, text string")
    out = rs.resample(clashing, target, max_run=1)
    assert got(out) == plain_resample(texts, ["data model corpus data"], 1, rs.BUCKETS, 20, 10)
    assert set(out.dtypes) == {(c, "bigint") for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank")}
    assert rs.resample(empty, target).count() == 0
    nothing = rs.resample(docs, target.limit(0), max_run=1)
    assert got(nothing) == plain_resample(texts, [], 1, rs.BUCKETS, 20, 10)


def test_resampling_draws_repeated_rows_each_and_breaks_ties_by_id(spark):
    text = " ".join(["same"] * 25)
    rows = [(1, text)] * 6 + [(None, text)] * 2 + [(2, text)] * 2 + [(3, "short")]
    target = spark.createDataFrame([("same",)], "text string")
    out = rs.resample(spark.createDataFrame(rows, "doc_id bigint, text string"), target, max_run=1, share=50)
    assert got(out) == plain_resample(rows, ["same"], 1, rs.BUCKETS, 20, 50)
    assert sorted(r["rank"] for r in out.collect() if r["rank"]) == [1, 2, 3, 4, 5]


def test_a_carried_state_is_the_plain_checksum():
    v = rs.HeadTail([b"data", "für".encode()], [b"data model"], 101)
    for f in ("data", "für", "data model", "data shard", "für elise ja", "none here", "x"):
        assert v.bucket(f.encode()) == zlib.crc32(f.encode()) % 101
    assert [w.decode() for w in rs.words_of("A b_C 9é\n漢字-x".encode())] == ["a", "b", "c", "9é", "漢字", "x"]


# --- whitening -----------------------------------------------------------------------

def plain_whitening(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    white = (x - s / n) @ axes[:, :k] / np.sqrt(values[:k])
    deviation = [int(v) for v in ((n * x.astype(object) - s.astype(object)) ** 2).sum(axis=1)]
    return n, deviation, white, values[:k] / values.sum()


def frame(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], None if v is None else [None if c is None else float(c) for c in v])
            for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").select("vec_id", "embedding", F.lit(1).alias("n"))


def test_whitening_equals_a_float_decomposition(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(120, 9)) @ rng.normal(size=(9, 9)) + 3).astype(np.float32)
    vectors = np.concatenate([vectors, vectors[:7], vectors[:7]])                # repeated vectors count once in the fit
    out = wh.whiten_embeddings(frame(spark, vectors), components=5).toPandas().sort_values(["vec_id", "component"])
    n, deviation, white, explained = plain_whitening(vectors, 5)
    got_ = out.whitened.to_numpy().reshape(-1, 5)
    signs = np.sign((got_ * white).sum(axis=0))
    assert np.abs(got_ * signs - white).max() < 1e-9
    assert out.n.unique().tolist() == [n] == [120] and out.deviation[::5].tolist() == deviation
    assert out.explained.to_numpy()[:5] == pytest.approx(explained, rel=1e-9)
    assert out.identity_error.nunique() == 1 and out.identity_error.iloc[0] < 1e-9
    assert [t for _, t in wh.whiten_embeddings(frame(spark, vectors)).dtypes] == [
        "bigint", "int", "bigint", "bigint", "double", "double", "double"]


def test_whitening_drops_unusable_rows_and_keeps_null_ids(spark):
    good = [[1, 0.5], [2, -1], [0.25, 3], [1, 0.5]]
    bad = [None, [None, 1], [float("nan"), 1], [float("inf"), 1], [1], [], [1, 2, 3]]
    out = wh.whiten_embeddings(frame(spark, good + bad, ids=[10, None, 12, 10] + [99] * len(bad))).toPandas()
    assert sorted(out.vec_id.fillna(-1).astype(int)) == [-1, -1, 10, 10, 10, 10, 12, 12] and set(out.n) == {3}
    for vectors in ([], [None], [[1, 2]], [[1, 2]] * 3, [[]]):
        assert wh.whiten_embeddings(frame(spark, vectors)).count() == 0


def test_whitening_of_equal_eigenvalues_and_of_a_dependent_dimension(spark):
    cross = [[1, 0, 0], [-1, 0, 0], [0, 1, 0], [0, -1, 0], [0, 0, 2], [0, 0, -2]]
    out = wh.whiten_embeddings(frame(spark, cross)).toPandas()
    assert out.component.nunique() == 3 and out.identity_error.iloc[0] < 1e-12       # the first two are a pair of equals
    flat = [[a, 2 * a, b] for a, b in [(1, 0), (2, 5), (3, 1), (5, 2)]]              # one dimension is twice another
    out = wh.whiten_embeddings(frame(spark, flat)).toPandas()
    assert out.component.nunique() == 2 and out.identity_error.iloc[0] < 1e-12
    assert out.explained[:2].sum() == pytest.approx(1)


def test_whitening_of_very_large_entries_is_exact(spark):
    vectors = [[2.0 ** 40, 3], [-(2.0 ** 41), 1], [2.0 ** 39, -7], [5, 5]]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    out = wh.whiten_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).toPandas()
    assert out.identity_error.iloc[0] < 1e-9 and out.deviation.isna().all()          # beyond a long


def test_polynomial_roots_and_sums_are_exact(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(-9, 9, (6, 5))
    m = [[int(v) for v in row] for row in a.T @ a]
    poly = wh.characteristic_polynomial(spark, m)
    for x in (-3, 0, 7, 50):
        shifted = [[Fraction(x * (i == j) - m[i][j]) for j in range(5)] for i in range(5)]
        det = Fraction(1)
        for k in range(5):                                                          # exact elimination
            r = next((i for i in range(k, 5) if shifted[i][k]), None)
            if r is None:
                det = Fraction(0)
                break
            if r != k:
                shifted[k], shifted[r], det = shifted[r], shifted[k], -det
            det *= shifted[k][k]
            for i in range(k + 1, 5):
                f = shifted[i][k] / shifted[k][k]
                shifted[i] = [p - f * q for p, q in zip(shifted[i], shifted[k])]
        assert sum(c * x ** (5 - k) for k, c in enumerate(poly)) == det
    roots = [1, -6, 12, -8]                                                         # (x - 2) three times
    assert [wh.roots_above(roots, x, 0) for x in (0, 1, 2, 3)] == [3, 3, 0, 0]
    assert wh.isolate(roots, 1, 7) == wh.isolate(roots, 3, 7) and wh.isolate(roots, 4, 7) is None
    z = rng.integers(-(1 << 40), 1 << 40, (50, 3))
    assert (wh.outer_sum(z) == z.astype(object).T @ z.astype(object)).all()
    for v in (0, 5, -5, 1 << 70, -(1 << 70), (1 << 32) - 1, -(1 << 32)):
        assert sum(d << (wh.LIMB * k) for k, d in enumerate(wh.limbs(v))) == v
    keys = wh.pack(np.array([[1, -2], [40_000, 0], [1 << 40, 3], [-32_768, 32_767]]))
    assert [k[0] for k in keys] == [2, 4, 8, 2] and wh.unpack(keys, 2).tolist() == [[1, -2], [40_000, 0], [1 << 40, 3], [-32_768, 32_767]]


# --- toxicity --------------------------------------------------------------------------

INSULTS = ["blockhead", "dimwit", "lowlife", "scoundrel"]


@pytest.fixture(scope="module")
def toxic(spark):
    """Documents of which a third hold insults in one sentence, and their labels."""
    rng, rows, labels = random.Random(3), [], []
    for i in range(600):
        parts = [sentence(rng, rng.randint(5, 12)) for _ in range(rng.randint(2, 6))]
        bad = i % 3 == 0
        if bad:
            words = parts[i % len(parts)].split()
            words[len(words) // 2] = rng.choice(INSULTS)
            parts[i % len(parts)] = " ".join(words)
        rows.append((i, ". ".join(parts)))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def plain_kernel(a, b):
    """All subsequences of three symbols within the span, straight from the definition."""
    def features(word):
        s, out = ["^", "<", *(c if c.isalnum() else None for c in word), "$"], {}
        for i in range(len(s)):
            for j in range(i + 1, min(len(s), i + tx.SPAN)):
                for k in range(j + 1, min(len(s), i + tx.SPAN)):
                    if None not in (f := (s[i], s[j], s[k])):
                        out[f] = out.get(f, 0) + tx.DECAY ** (k - i + 1 - tx.ORDER)
        return out

    x, y = features(a), features(b)
    dot = lambda p, q: sum(v * q.get(f, 0) for f, v in p.items())
    value = dot(x, y) / math.sqrt(dot(x, x) * dot(y, y))
    return value ** tx.POWER if value >= tx.FLOOR else 0.0


def test_kernel_equals_the_definition():
    landmarks = ["blockhead", "dimwit", "scum", "aaaa"]
    words = ["blockhead", "block-head", "blxockhead", "b_l_o_c_k_h_e_a_d", "dimwits", "dimm", "scum", "aaaaa", "aaaaaaaa", "the", "x", "s.c.u.m"]
    kernel = tx.LandmarkKernel(landmarks)
    want = np.array([[plain_kernel(w, t) for t in landmarks] for w in words])
    assert kernel.matrix(words) == pytest.approx(want, abs=1e-5)
    assert kernel.matrix(words) == pytest.approx(want, abs=1e-5)                      # from the cache
    assert kernel.matrix(["x" * 30 + "dimwit" + "y" * 30, ""]).shape == (2, 4)


def peak_bytes(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_sentences_are_pooled_in_bounded_memory(monkeypatch):
    rng, n = random.Random(4), 20_000
    landmarks = [w + e for w in INSULTS for e in ("", "s", "y", "ed", "er", "ing", "ish", "est")]
    kernel = tx.LandmarkKernel(landmarks)
    model = tx.ToxicityModel(landmarks, np.array([rng.uniform(-1, 1) for _ in landmarks]), 0.25)
    words = ["the", "data", *landmarks, *(tx.disturbed(w) for w in landmarks)]
    chosen = [[rng.choice(words) for _ in range(rng.randint(1, 5))] for _ in range(n)]
    chosen[0] = words * 400
    text_of = np.sort(np.array([rng.randrange(30) for _ in range(n)]))
    tokens = tx.Tokens.of_sentences(chosen)
    tokens.text_of, tokens.n_texts = text_of, 31
    of_word = dict(zip(words, kernel.matrix(words)))
    want = np.array([np.max([of_word[w] for w in s], axis=0) for s in chosen])
    assert (kernel.pooled(tokens) == want).all()
    decided, most = peak_bytes(lambda: model.decisions(kernel, tokens))
    each = want @ model.weights
    for t in range(30):
        own = text_of == t
        assert decided[t] == pytest.approx(0.25 + max(each[own].max(), want[own].max(axis=0) @ model.weights))
    assert decided[30] == 0.25
    # a few numbers a word and blocks of fixed size, not rows of values of all sentences
    assert most < 80 * len(tokens.code) + 20 * 8192 * len(landmarks)
    monkeypatch.setattr(tx, "POOLED", 3)                                              # sentences of more than a block
    assert (kernel.pooled(tokens) == want).all()
    assert model.decisions(kernel, tokens) == pytest.approx(decided, abs=1e-12)


def test_products_with_landmarks_take_bounded_memory():
    landmarks = [f"blockhead{c}{d}" for c in "abcdefghijklmn" for d in "abcdefghijklmnop"]
    kernel = tx.LandmarkKernel(landmarks)
    units = [f"blockhead{a}{b}{c}" for a in "abcdefghijklmnop" for b in "abcdefghijklmnop" for c in "abcdefgh"]
    (at, rows), most = peak_bytes(lambda: kernel.rows(units))
    assert at.tolist() == list(range(len(units)))
    part = kernel.rows(units[700:701])[1]
    assert (rows[700] == part[0]).all()
    # the rows are returned; the entries that landmarks share with the words come in small runs
    assert most - 2 * rows.nbytes < 150 << 20


def test_words_and_sentences():
    t = tx.Tokens.of(pa.array(["Hello THERE! you I d i o t ok.\nnext (line)\n\n", None, "", "a. b", "e.g. so"]))
    assert t.words_of(np.arange(len(t.text_of))) == [
        ["hello", "there"], ["you", "i", "d", "i", "o", "t", "ok", "i_d_i_o_t"], ["next", "line"], ["a"], ["b"], ["e.g"], ["so"]]
    assert t.text_of.tolist() == [0, 0, 0, 3, 3, 4, 4]


def test_toxic_documents_are_told_from_clean_ones(spark, toxic):
    docs, labels = toxic
    out = {r.doc_id: r for r in tx.score_toxicity(docs, labels).collect()}
    held = [i for i in out if fold(i, 3) == 1]
    assert all(out[i].held_out == (fold(i, 3) == 1) for i in out) and len(held) > 150
    assert np.mean([out[i].predicted == (i % 3 == 0) for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= tx.THRESHOLD) for r in out.values())


def test_gapped_and_inserted_insults_and_odd_texts(spark, toxic):
    docs, labels = toxic
    base = "the model and data of a shard. for %s merge corpus. token with the"
    bad = ["dimwit", "DIMWIT!", "dim-wit", "dim.wit", "d_i_m_w_i_t", "dimxwit", "block head".replace(" ", "-"), "sc*oundrel", "d i m w i t"]
    clean = ["data", "merging", "token", "d a t a", "", "x"]
    rows = [(10_000 + i, base % w) for i, w in enumerate(bad + clean)]
    rows += [(None, None), (20_000, ""), (20_001, "!!! ... \n\n"), (20_002, "word " * 50_000 + "dimwit"), (20_003, "ab" * 40_000), (20_002, None)]
    more = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("TOXIC", F.lit(1))
    out = tx.score_toxicity(docs.withColumn("TOXIC", F.lit(0)).unionByName(more), labels).where("doc_id is null or doc_id >= 10000").collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(out) == len(rows)
    flagged = [by_id[10_000 + i][0].predicted for i in range(len(bad) + len(clean))]
    assert sum(flagged[:len(bad)]) >= len(bad) - 1 and sum(flagged[len(bad):]) == 0
    assert by_id[None][0].held_out is False and by_id[None][0].predicted == by_id[20_000][0].predicted == 0
    assert sorted(r.predicted for r in by_id[20_002]) == [0, 1] and by_id[20_003][0].predicted == 0


def test_fit_does_not_depend_on_the_order_of_rows_and_copies(spark, toxic):
    docs, labels = toxic
    few = docs.where("doc_id < 90")
    doubled = few.unionByName(few.withColumn("text", F.upper("text"))).unionByName(few)
    twice = labels.unionByName(labels.where("doc_id < 10"))

    def scores(parts):
        out = tx.score_toxicity(doubled.repartition(parts), twice.repartition(parts)).collect()
        return sorted((r.doc_id, round(r.score, 9)) for r in out)

    assert scores(1) == scores(7)


def test_nothing_to_learn_from(spark, toxic):
    docs, labels = toxic
    for given in (labels.limit(0), labels.where("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        assert {r.score for r in tx.score_toxicity(docs.limit(5), given).collect()} == {0.5}
    assert tx.score_toxicity(docs.limit(0), labels).count() == 0


def test_calibration_rises():
    f, y = np.array([-2, -1, -1, 0, 1, 2, 3.0]), np.array([0, 0, 1, 0, 1, 1, 1.0])
    at, share = tx.fit_calibration(f, y)
    assert at == sorted(at) and share == sorted(share) and 0 < share[0] < share[-1] < 1
