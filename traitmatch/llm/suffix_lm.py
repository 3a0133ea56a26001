"""Language-model scores: a probabilistic suffix tree, beside an exact unigram base.

Both are learned from every training text.  One pass counts words and byte
6-grams (pre-aggregated in each task); sums meet in one shuffle.

* Base: the unigram score needs each token's corpus count.  The most frequent
  words (a fixed number, ``HEAD_WORDS``) go to the tasks as a table of bounded
  size; all other tokens of a text find their counts in a shuffled join, so the
  result is exact for any vocabulary.
* Tree: symbols are the bytes of the lower-cased words joined by single spaces
  and closed by an end symbol.  A context of up to ``DEPTH`` bytes is kept if its
  divergence from its suffix, weighted by its count (the nats it saves on the
  training text), is at least ``GAIN`` times the square root of the number of positions,
  and at least ``LEAST_NATS`` (in a small corpus, contexts save less than that by chance).
  The test is a Spark join of each context with its suffix, and only kept contexts
  leave the cluster.  The nats that all contexts of one length save are at most
  log(256) a position, so at most log(256) / GAIN * sqrt(positions) contexts of each length can
  pass: the tree grows with the corpus, but slower, so that it can still be broadcast.  Distributions are smoothed toward the
  suffix's own, down to the root; each symbol is scored in the longest kept suffix of what precedes it.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.llm.common import byte_slices, texts_of
from traitmatch.llm.contexts import PAD, ContextTable
from traitmatch.llm.langid import gram_counts, remainder
from traitmatch.plans.lineage import cut_lineage

DEPTH = 5
GAIN = 0.02
LEAST_NATS = 10.0          # outweighs GAIN below 250,000 positions
MOST_NATS = math.log(256)  # saved by all contexts of one length together, a position
WEIGHT = 2.0               # pseudo-count of the suffix's distribution
ROOT_COUNT = 0.1           # added to every byte's count at the root
HEAD_WORDS = 100_000
HELD_WORDS = 300_000       # distinct words a task holds before it passes its counts on
GRAM_BYTES = 4 << 20
END = b"\n"                # cannot occur in a word
ADD = 0.1                  # the base score's additive smoothing


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes.lower() and bytes.split() touch ASCII only, split at \\x20, \\x09-\\x0D."""
    return (text or "").encode().lower().split()


def corpus_counts(training: DataFrame) -> DataFrame:
    """``(kind, key, n)``: word counts (kind 0, the end token as ``\\n``) and byte 6-gram counts (kind 1)."""
    schema = "kind int, key binary, n bigint"

    def batch_of(kind, keys, counts):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(counts), kind, np.int32)), keys,
                                           pa.array(counts, pa.int64())], names=["kind", "key", "n"])

    def run(batches):
        words: Counter = Counter()
        streams: list[bytes] = []
        held = 0
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def word_batch():
            return batch_of(0, pa.array(list(words), pa.binary()), list(words.values()))

        def merged():
            c, n = gram_counts(streams, DEPTH)
            c, n = np.concatenate([codes, c]), np.concatenate([counts, n])
            c, at = np.unique(c, return_inverse=True)
            return c, np.bincount(at, weights=n, minlength=len(c)).astype(np.int64)

        for batch in batches:
            for part in byte_slices(batch, 0, GRAM_BYTES):
                for text in part.column(0).to_pylist():
                    tokens = words_of(text)
                    words.update(tokens)
                    words[END] += 1
                    streams.append(b" ".join(tokens) + END)
                    held += len(streams[-1])
                    if held > GRAM_BYTES:
                        codes, counts = merged()
                        streams, held = [], 0
                if len(words) > HELD_WORDS:
                    yield word_batch()
                    words.clear()
        if words:
            yield word_batch()
        if streams:
            codes, counts = merged()
        step = 1 << 18
        for i in range(0, len(codes), step):
            raw = np.ascontiguousarray(codes[i:i + step].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 7 - DEPTH:])
            keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(DEPTH + 1), len(raw), [None, pa.py_buffer(raw)])
            yield batch_of(1, keys.cast(pa.binary()), counts[i:i + step])

    return (training.mapInArrow(run, schema).groupBy("kind", "key").agg(F.sum("n").alias("n")))


def kept_contexts(grams: DataFrame, gain: float | None = None) -> DataFrame:
    """``context, total, cells`` (next symbol, count) of the root and of every context (length 1 to DEPTH)
    whose count-weighted divergence from its suffix is at least ``gain`` * sqrt(positions)
    (not given: ``GAIN`` * sqrt(positions), but ``LEAST_NATS`` at least).

    One occurrence saves at most log(positions), so a context whose count alone cannot reach the limit is
    left out before the join; its suffixes always have its count or more, so each context meets its suffix.
    """
    positions = grams.agg(F.sum("n")).first()[0] or 0
    least = max(GAIN * math.sqrt(positions), LEAST_NATS) if gain is None else gain * math.sqrt(positions)
    by_length = grams.select(F.explode(F.array(*[F.lit(k) for k in range(DEPTH + 1)])).alias("k"), "key", "n")
    cells = F.collect_list(F.struct(F.conv(F.hex("next"), 16, 10).cast("int").alias("s"), "n"))
    counted = (by_length.select(F.expr(f"substring(key, {DEPTH + 1} - k, k)").alias("context"),
                                F.expr(f"substring(key, {DEPTH + 1}, 1)").alias("next"), "n")
               .groupBy("context", "next").agg(F.sum("n").alias("n"))
               .groupBy("context").agg(F.sum("n").alias("total"), cells.alias("cells"))
               .filter((F.octet_length("context") == 0) | (F.col("total") * F.lit(math.log(max(2, positions))) >= F.lit(least))))
    rows = cut_lineage(counted, "lm_contexts")
    suffixes = rows.select(F.col("context").alias("_c"), F.col("total").alias("_t"),
                           F.map_from_entries("cells").alias("_m"))
    saved = F.aggregate("cells", F.lit(0.0), lambda acc, x: acc + x["n"] * F.ln(
        x["n"] / F.col("total") / (F.col("_m")[x["s"]] / F.col("_t"))))
    longer = (rows.filter(F.octet_length("context") > 0)
              .join(suffixes, F.expr("substring(context, 2)") == F.col("_c")).filter(saved >= F.lit(least)))
    return rows.filter(F.octet_length("context") == 0).unionByName(longer.select(*rows.columns))


def context_counts(grams: DataFrame, gain: float | None = None) -> dict[bytes, dict[int, int]]:
    """Next-symbol counts of the kept contexts: at most MOST_NATS / gain (or GAIN) * sqrt(positions) of a length, one row each."""
    table = kept_contexts(grams, gain).select("context", "cells.s", "cells.n").toArrow()
    return {bytes(c): dict(zip(symbols, ns)) for c, symbols, ns in zip(*(table.column(i).to_pylist() for i in range(3)))}


class SuffixTree:
    """Kept contexts with smoothed next-symbol distributions, as one table of log10 probabilities."""

    def __init__(self, counts: dict[bytes, dict[int, int]]):
        root = np.full(256, ROOT_COUNT)
        for s, n in counts.get(b"", {}).items():
            root[s] += n
        probs = {b"": root / root.sum()}
        alphabet = bytes(counts.get(b"", {})) + END
        kept = [b""]
        for context in sorted((c for c in counts if c), key=lambda c: (len(c), c)):
            suffix = context[1:]
            while suffix not in probs:
                suffix = suffix[1:]
            vector = np.zeros(256)
            for s, n in counts[context].items():
                vector[s] = n
            probs[context] = (vector + WEIGHT * probs[suffix]) / (vector.sum() + WEIGHT)
            kept.append(context)
        self.table = ContextTable(alphabet, kept)
        known = self.table.bytes_of
        other = next((b for b in range(256) if b not in set(known)), 255)
        rows = np.stack([probs[c][[*known, *([other] if self.table.size > len(known) else [])]]
                         for c in self.table.contexts])
        self.log10 = np.log10(rows).astype(np.float32).reshape(-1)
        self.probs = probs

    def scores(self, streams: list[bytes]) -> np.ndarray:
        """log10 probability of each (non-empty) symbol stream."""
        data = np.frombuffer(b"".join(PAD + s for s in streams), np.uint8)
        symbols = self.table.symbol[data]
        logs = self.log10[self.table.states(symbols) * self.table.size + symbols[len(PAD):]]
        sizes = np.array([len(s) for s in streams]) + len(PAD)
        ends = np.cumsum(sizes)
        bounds = np.column_stack([ends - sizes, ends - len(PAD)]).reshape(-1)
        return np.add.reduceat(np.append(logs, np.float32(0)), bounds, dtype=np.float64)[::2]


_BUILT: list[tuple] = []


def _model(shared):
    """Tree and head-word table, built once per Python worker and broadcast; the broadcast value is held
    beside them, so that no other one can be taken for it."""
    value = shared.value
    if not _BUILT or _BUILT[0][0] is not value:
        counts, (words, ns), denominator = value
        _BUILT[:] = [(value, SuffixTree(counts), {w: math.log10((n + ADD) / denominator) for w, n in zip(words, ns)})]
    return _BUILT[0][1:]


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD_WORDS,
                    modulus: int = 10) -> DataFrame:
    """Base and tree score of every whole text; one row per input row, repeated rows included.

    Learns from rows whose crc32(id) mod ``modulus`` is not 0 (a row without id
    belongs to no fold: it is scored, not learned from, ``held_out`` false).  A
    null or empty text is the end token alone.  With nothing to learn from, every
    count is 0.  An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = texts_of(docs, id_col, text_col)
    held_out = F.coalesce(remainder(F.col("doc_id"), modulus) == 0, F.lit(False))
    training = rows.filter(F.col("doc_id").isNotNull() & ~held_out).select("text")
    counts = cut_lineage(corpus_counts(training), "lm_counts")
    words = counts.filter("kind = 0").select("key", "n")
    n_tokens, n_words = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    denominator = n_tokens + ADD * (n_words + 1)
    top = words.orderBy(F.desc("n"), "key").limit(head).toArrow()          # bounded by ``head`` rows
    shared = spark.sparkContext.broadcast((context_counts(counts.filter("kind = 1")),
                                           (top.column("key").to_pylist(), top.column("n").to_pylist()),
                                           denominator))
    schema = ("doc_id bigint, held_out boolean, n_tokens bigint, head_known bigint, head_score double, "
              "score double, tail array<binary>")

    def run(batches):
        tree, known = _model(shared)
        for batch in batches:
            for part in byte_slices(batch, 2, 4 << 20):
                tokens = [words_of(t) + [END] for t in part.column(2).to_pylist()]
                sums, found, tails = [], [], []
                for each in tokens:
                    logs = [known.get(w) for w in each]
                    tail = [w for w, x in zip(each, logs) if x is None]
                    sums.append(math.fsum([x for x in logs if x is not None]))
                    found.append(len(each) - len(tail))
                    tails.append(tail)
                scores = tree.scores([b" ".join(each[:-1]) + END for each in tokens])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(list(map(len, tokens)), pa.int64()),
                     pa.array(found, pa.int64()), pa.array(sums, pa.float64()), pa.array(scores),
                     pa.array(tails, pa.list_(pa.binary()))],
                    names=["doc_id", "held_out", "n_tokens", "head_known", "head_score", "score", "tail"])

    # stored, so that row numbers are data and both branches below read the same rows
    scored = cut_lineage(rows.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(run, schema)
                         .withColumn("row_no", F.monotonically_increasing_id()), "lm_scored")
    tail = scored.select("row_no", F.explode("tail").alias("key"))
    value = F.coalesce(F.col("n"), F.lit(0))
    tail_sums = (tail.join(words, "key", "left")
                 .groupBy("row_no").agg(F.sum(F.log10((value + ADD) / F.lit(float(denominator)))).alias("tail_score"),
                                        F.sum((value > 0).cast("bigint")).alias("tail_known")))
    zero = F.lit(0)
    return (scored.drop("tail").join(tail_sums, "row_no", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("head_known") + F.coalesce("tail_known", zero)).cast("bigint").alias("n_known"),
                    F.lit(int(n_tokens)).cast("bigint").alias("train_tokens"),
                    (F.col("head_score") + F.coalesce("tail_score", F.lit(0.0))).alias("base_score"), "score"))
