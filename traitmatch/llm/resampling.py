"""Importance resampling of documents toward a target distribution.

Features are runs of consecutive words, hashed by CRC-32 into a fixed number of
buckets.  The log ratio of a bucket's smoothed shares in the target and in the
corpus is its gain; a document's weight is the sum of its features' gains, and a
Gumbel key drawn from its id turns "take the best" into sampling without
replacement in proportion to the weights.

Head-tail vocabulary: the most frequent words are broadcast with their CRC state
and the most frequent pairs with their bucket.  A CRC can be carried on from a
state, so a longer run never hashes its first word again; a feature outside the head takes
its CRC directly.  Either way a feature has one bucket, so the bucket totals are
exact whatever the head holds: the head saves work, it decides nothing.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.llm.common import arrow_batch, byte_slices, pick, schema_of
from traitmatch.plans.lineage import cut_lineage
from traitmatch.plans.ranking import global_rank

BUCKETS = 10_000
MAX_RUN = 2
SEED = 2024
HEAD_WORDS = 16_384           # proven bound of the broadcast: entries of at most HEAD_BYTES bytes each
HEAD_PAIRS = 16_384
HEAD_BYTES = 64
MIN_WORDS = 20
SHARE = 10                    # per cent of the eligible documents
FIELDS = [("doc_id", "bigint"), ("n_words", "bigint"), ("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint")]

# lower-case A-Z; every other ASCII byte that is no letter or digit separates words
_KEPT = {*range(48, 58), *range(97, 123), *range(128, 256)}
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEPT else 32 for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8: runs of ASCII letters, digits and all non-ASCII characters."""
    return raw.translate(_FOLD).split() if raw else []


def runs(words: list[bytes], n: int) -> list[bytes]:
    """All runs of ``n`` words, joined by one space."""
    return words if n == 1 else list(map(b" ".join, zip(*(words[k:] for k in range(n)))))


class HeadTail:
    """Buckets of features: head words and pairs from tables, the others by their CRC."""

    def __init__(self, words: list[bytes], pairs: list[bytes], buckets: int = BUCKETS):
        self.buckets = buckets
        self.states = {w: zlib.crc32(w) for w in words}
        self.pairs = {p: self.carried(p) for p in pairs}

    def carried(self, feature: bytes) -> int:
        """Bucket of a run, carried on from its first word's state where that is known."""
        first, space, rest = feature.partition(b" ")
        state = self.states.get(first)
        if state is None:
            return zlib.crc32(feature) % self.buckets
        return (zlib.crc32(space + rest, state) if space else state) % self.buckets

    def bucket(self, feature: bytes) -> int:
        known = self.pairs.get(feature)
        return self.carried(feature) if known is None else known

    def totals(self, texts: list[bytes | None], max_run: int) -> np.ndarray:
        """Occurrences of all features of some texts, per bucket."""
        out = np.zeros(self.buckets, np.int64)
        split = [words_of(t) for t in texts]
        for n in range(1, max_run + 1):
            counted = Counter(chain.from_iterable(runs(w, n) for w in split))
            at = np.fromiter(map(self.bucket, counted), np.int64, len(counted))
            np.add.at(out, at, np.fromiter(counted.values(), np.int64, len(counted)))
        return out


class Gains(dict):
    """Gain of each feature: head features are stored, the others are looked up by their bucket."""

    def __init__(self, vocabulary: HeadTail, gains: list[int]):
        super().__init__((f, gains[vocabulary.bucket(f)]) for f in chain(vocabulary.states, vocabulary.pairs))
        self._bucket, self._gains = vocabulary.bucket, gains

    def __missing__(self, feature: bytes) -> int:
        return self._gains[self._bucket(feature)]


def _raw(df: DataFrame, text_col: str) -> DataFrame:
    return pick(df, text=text_col).select(F.col("text").cast("string").cast("binary").alias("text"))


def head_features(texts: DataFrame, max_run: int, head_words: int = HEAD_WORDS,
                  head_pairs: int = HEAD_PAIRS) -> tuple[list[bytes], list[bytes]]:
    """The most frequent words and pairs of all texts (ties: byte order).

    A task counts in a table that it cuts back to its most frequent entries, so its
    memory is bounded and the counts are lower bounds; they only choose the head.
    """
    sizes = {1: head_words, 2: head_pairs if max_run > 1 else 0}

    def run(batches):
        held = {n: Counter() for n, size in sizes.items() if size}
        for batch in batches:
            for part in byte_slices(batch, 0):
                split = [words_of(t) for t in part.column(0).to_pylist()]
                for n, counts in held.items():
                    counts.update(f for f in chain.from_iterable(runs(w, n) for w in split) if len(f) <= HEAD_BYTES)
                    if len(counts) > 8 * sizes[n]:
                        held[n] = Counter(dict(counts.most_common(4 * sizes[n])))
        for n, counts in held.items():
            top = counts.most_common(2 * sizes[n])
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * len(top), pa.int32()), pa.array([f for f, _ in top], pa.binary()),
                 pa.array([c for _, c in top], pa.int64())], names=["run", "feature", "n"])

    counted = (texts.mapInArrow(run, "run int, feature binary, n bigint")
               .groupBy("run", "feature").agg(F.sum("n").alias("n")))
    out = []
    for n, size in sizes.items():
        top = counted.filter(F.col("run") == n).orderBy(F.col("n").desc(), "feature").limit(size) if size else None
        out.append([bytes(r.feature) for r in top.select("feature").toLocalIterator()] if size else [])
    return out[0], out[1]


def bucket_totals(texts: DataFrame, shared, max_run: int, buckets: int) -> np.ndarray:
    """Exact feature count of every bucket over all texts (at most ``buckets`` rows reach the driver)."""
    def run(batches):
        out = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in byte_slices(batch, 0):
                out += shared.value.totals(part.column(0).to_pylist(), max_run)
        at = np.nonzero(out)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(out[at], pa.int64())], names=["bucket", "n"])

    rows = (texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))).collect()
    totals = np.zeros(buckets, np.int64)
    for r in rows:
        totals[r.bucket] = r.n
    return totals


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 * log ratio) of the smoothed shares of every bucket."""
    b, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return [math.floor(1000 * math.log((t_ + 1.0) * (s + b) / ((s_ + 1.0) * (t + b))))
            for s_, t_ in zip(map(float, corpus), map(float, target))]


def gumbel_key(doc_id: int | None, seed: int = SEED) -> int:
    """floor(1000 * a Gumbel variate) fixed by the id (a null id counts as an empty one)."""
    name = "" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_rows(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               target_text_col: str = "text", max_run: int = MAX_RUN, buckets: int = BUCKETS, seed: int = SEED,
               head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every document (lazy but for the corpus counts)."""
    texts = _raw(docs, text_col)
    vocabulary = HeadTail(*head_features(texts, max_run, head_words, head_pairs), buckets)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    gains = bucket_gains(bucket_totals(texts, shared, max_run, buckets),
                         bucket_totals(_raw(target, target_text_col), shared, max_run, buckets))

    def run(batches):
        gain = Gains(shared.value, gains).__getitem__
        for batch in batches:
            for part in byte_slices(batch, 1):
                ids, made = part.column(0).to_pylist(), []
                for doc_id, raw in zip(ids, part.column(1).to_pylist()):
                    words, n, weight = words_of(raw), 0, 0
                    for k in range(1, max_run + 1):
                        features = runs(words, k)
                        n += len(features)
                        weight += sum(map(gain, features))
                    made.append((doc_id, len(words), n, weight, weight + gumbel_key(doc_id, seed)))
                yield arrow_batch(FIELDS, list(zip(*made)) if made else [[]] * len(FIELDS))

    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, schema_of(FIELDS))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", max_run: int = MAX_RUN, buckets: int = BUCKETS, seed: int = SEED,
             min_words: int = MIN_WORDS, share: int = SHARE, head_words: int = HEAD_WORDS,
             head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document.

    Of the N documents with ``min_words`` words or more, the floor(share * N / 100)
    highest scores are drawn and numbered from 1 (ties: the smaller id; a row
    without id comes last of a tie); all others have a null rank.  Every row gets a row: a null or
    wordless text has no feature and weight 0, repeated rows count and rank each for
    themselves, a null id draws its key as an empty one.  An empty target gives
    gains against a flat distribution; an empty table gives no rows; other columns
    are ignored.
    """
    scored = cut_lineage(score_rows(docs, target, id_col, text_col, target_text_col, max_run, buckets, seed,
                                    head_words, head_pairs), "resampling_scores")
    eligible = F.col("n_words") >= min_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "weight", "n_features"]
    drawn = scored.filter(eligible).count() * share // 100
    ranked = global_rank(scored.filter(eligible), order)
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    names = [n for n, _ in FIELDS]
    return (ranked.select(*names, rank.alias("rank"))
            .unionByName(scored.filter(~eligible).select(*names, F.lit(None).cast("bigint").alias("rank"))))


RESAMPLE_SQL = r"""
WITH crc_table AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)
                ORDER BY i) AS t FROM range(256) r(i)
), texts AS (
    SELECT 0 AS side, doc_id AS id, row_number() OVER () AS row, text FROM documents
    UNION ALL SELECT 1, item_id, row_number() OVER (), text FROM benchmark
), split AS (
    SELECT side, id, row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), features AS (SELECT side, row, unnest(w) AS f FROM split
), counted AS (SELECT side, row, f, count(*) AS n FROM features GROUP BY ALL
), hashed AS (
    SELECT f, xor(4294967295, list_reduce(list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) % 10000 AS bucket
    FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)), crc_table
), totals AS (
    SELECT b AS bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t
    FROM range(10000) r(b) LEFT JOIN (SELECT * FROM counted JOIN hashed USING (f)) c ON c.bucket = b GROUP BY b
), gains AS (
    SELECT bucket, floor(1000 * ln((t::DOUBLE + 1) * (sum(s) OVER () + 10000)::DOUBLE
           / ((s::DOUBLE + 1) * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM totals
), weights AS (
    SELECT row, sum(n * gain)::BIGINT AS weight FROM counted JOIN hashed USING (f) JOIN gains USING (bucket)
    WHERE side = 0 GROUP BY row
), scored AS (
    SELECT id AS doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296)))::BIGINT AS score
    FROM split LEFT JOIN weights USING (row) WHERE side = 0
), placed AS (
    SELECT *, row_number() OVER (ORDER BY n_words < 20, score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS n
    FROM scored
)
SELECT doc_id, n_words, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 10 * n // 100 THEN place END AS rank
FROM placed
"""
