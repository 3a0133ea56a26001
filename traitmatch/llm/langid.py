"""Language identification by prediction by partial matching.

Each language has a context tree over bytes (orders 0 to 3).  With statistics
frozen after training, the code length of a byte after its last three bytes is a
fixed number: its share in the longest context where it was seen, times the
escape probabilities of the longer contexts (escape method C, with the symbols
of a longer context excluded from the shorter ones).  All code lengths go into
one table, so a text's exact code length under every language is a sum of table
entries; the language with the shortest code wins.

A table holds contexts x alphabet x languages numbers.  Languages whose table would
be larger than ``TABLE_BYTES`` are scored block by block: each block is one pass over
the texts, whose results (a few numbers a text) meet in a shuffle.  The blocks share
one alphabet, so the code lengths are those of one table.  A table is built once, on
the driver, from counts of a bounded sample, and broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitmatch.llm.common import arrow_batch, byte_slices, pick, schema_of
from traitmatch.llm.contexts import PAD, ContextTable
from traitmatch.plans.lineage import cut_lineage, number_rows

ORDER = 3
TRAIN_DOCS_PER_LANG = 400     # documented bound of the training sample: whole texts per language
PICK_PARTS = 64
BLOCK_LANGS = 64              # languages whose sample is counted at once
TABLE_BYTES = 64 << 20        # of one table of code lengths; a single language may need more
COUNT_BYTES = 4 << 20         # text bytes counted at once
LETTER = re.compile(r"[^\W\d_]")
FIELDS = [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double"),
          ("bits_per_byte", "double")]


def gram_counts(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(order + 1)-grams of padded texts as integers, with their counts."""
    data = np.frombuffer(b"".join(PAD + t for t in texts), np.uint8).astype(np.int64)
    starts = np.cumsum([0, *(len(t) + len(PAD) for t in texts)][:-1]) if texts else np.zeros(0, np.int64)
    code = np.zeros(max(0, len(data) - order), np.int64)
    for k in range(order + 1):
        code = code * 256 + data[k:len(data) - order + k]
    # a gram predicts its last byte; drop those that predict padding
    real = np.ones(len(data), bool)
    for k in range(len(PAD)):
        real[starts + k] = False
    return np.unique(code[real[order:]], return_counts=True)


class ContextModels:
    """PPM context trees of several languages, frozen into one code-length table."""

    def __init__(self, langs: list[str], grams: list[tuple[np.ndarray, np.ndarray]], order: int = ORDER,
                 others: bytes = b""):
        """``others``: bytes seen in the training texts of languages outside this table."""
        self.langs = langs
        trees = []
        seen: set[int] = set()
        for codes, counts in grams:
            tree: dict[bytes, dict[int, int]] = {}
            for code, n in zip(codes.tolist(), counts.tolist()):
                raw = code.to_bytes(order + 1, "big")
                seen.add(raw[-1])
                for k in range(order + 1):
                    node = tree.setdefault(raw[k:order], {})
                    node[raw[-1]] = node.get(raw[-1], 0) + n
            trees.append(tree)
        alphabet = bytes(seen | {10, *others})
        self.table = ContextTable(alphabet, [c for t in trees for c in t])
        a = self.table.size
        self.bits = np.empty((len(self.table.contexts), a, len(langs)), np.float32)
        for j, tree in enumerate(trees):
            vectors = {c: self._vector(node, a) for c, node in tree.items()}
            made: dict[bytes, np.ndarray] = {}
            for i, context in enumerate(self.table.contexts):
                # a context this language has not seen escapes to its longest seen suffix at no cost
                while context and context not in vectors:
                    context = context[1:]
                if context not in made:
                    made[context] = self._code_lengths(context, vectors, a)
                self.bits[i, :, j] = made[context]
        self.bits = self.bits.reshape(-1, len(langs))

    def _vector(self, node: dict[int, int], a: int) -> np.ndarray:
        v = np.zeros(a)
        v[self.table.symbol[list(node)]] = list(node.values())
        return v

    @staticmethod
    def _code_lengths(context: bytes, vectors: dict[bytes, np.ndarray], a: int) -> np.ndarray:
        """Bits of every symbol after ``context`` in one language's tree."""
        p, mass, open_ = np.zeros(a), 1.0, np.ones(a, bool)
        for k in range(len(context) + 1):
            counts = vectors.get(context[k:])
            if counts is None:
                continue
            counts = counts * open_
            n, kinds = counts.sum(), np.count_nonzero(counts)
            if kinds:
                p += mass * counts / (n + kinds)
                mass *= kinds / (n + kinds)
                open_ &= counts == 0
        if open_.any():
            p[open_] += mass / open_.sum()
        return -np.log2(p / p.sum())

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each (non-empty) text under each language."""
        data = np.frombuffer(b"".join(PAD + t for t in texts), np.uint8)
        symbols = self.table.symbol[data]
        at = self.table.states(symbols) * self.table.size + symbols[len(PAD):]
        sizes = np.array([len(t) for t in texts]) + len(PAD)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        # position t of the data is entry t-len(PAD) here; a text's bytes are entries [start, end-len(PAD))
        bounds = np.column_stack([starts, ends - len(PAD)]).reshape(-1)
        out = np.empty((len(texts), len(self.langs)))
        for j in range(len(self.langs)):
            bits = self.bits[:, j][at]
            out[:, j] = np.add.reduceat(np.append(bits, np.float32(0)), bounds, dtype=np.float64)[::2]
        return out


def training_counts(rows: DataFrame, per_lang: int = TRAIN_DOCS_PER_LANG, order: int = ORDER) -> DataFrame:
    """``lang, gram, n``: gram counts of a bounded sample per language, for one block of languages.

    ``rows`` has ``doc_id, lang, text``; the ``per_lang`` ids with the smallest hash
    of each language are picked on ids alone, then their whole texts are read by a
    join with those few ids.  A language is first cut into ``PICK_PARTS`` parts,
    each of which passes on at most ``per_lang`` ids, so that the last pick meets a
    bounded number of rows however many map tasks there are.  A repeated id counts once, with
    the text of the least digest.
    """
    def first(ids: DataFrame, *keys: str) -> DataFrame:
        at = F.row_number().over(Window.partitionBy(*keys).orderBy("_key", "_id"))
        return ids.withColumn("_n", at).filter(F.col("_n") <= per_lang).drop("_n")

    ids = rows.select("lang", F.col("doc_id").alias("_id"), F.xxhash64("doc_id").alias("_key")).distinct()
    parted = ids.withColumn("_part", F.pmod("_key", F.lit(PICK_PARTS)))
    picked = first(first(parted, "lang", "_part"), "lang").select("lang", "_id")
    # at most BLOCK_LANGS x per_lang ids
    sample = rows.join(F.broadcast(picked.withColumnRenamed("lang", "_lang")),
                       (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")

    def least(batches):
        held: dict[tuple[str, int], tuple[bytes, str]] = {}      # at most one text a picked id
        for batch in batches:
            for lang, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                digest = hashlib.sha256(text.encode()).digest()
                if (lang, doc_id) not in held or digest < held[lang, doc_id][0]:
                    held[lang, doc_id] = digest, text
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.int64()),
             pa.array([d for d, _ in held.values()], pa.binary()), pa.array([t for _, t in held.values()], pa.string())],
            names=["lang", "doc_id", "digest", "text"])

    one = (sample.select("lang", "doc_id", "text").mapInArrow(least, "lang string, doc_id bigint, digest binary, text string")
           .groupBy("lang", "doc_id").agg(F.min(F.struct("digest", "text")).alias("_one")))

    def count(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, COUNT_BYTES):
                by: dict[str, list[bytes]] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    by.setdefault(lang, []).append(text.encode())
                for lang, texts in by.items():
                    codes, n = gram_counts(texts, order)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes),
                                                      pa.array(n)], names=["lang", "gram", "n"])

    return (one.select("lang", "_one.text").mapInArrow(count, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def collected(counts: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Gram counts by language; bounded: at most BLOCK_LANGS x per_lang texts were counted."""
    frame = counts.toArrow().to_pandas().sort_values(["lang", "gram"])
    return {lang: (g["gram"].to_numpy(np.int64), g["n"].to_numpy(np.int64)) for lang, g in frame.groupby("lang")}


def contexts_of(grams: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The contexts of grams, of all lengths, as numbers."""
    before = grams >> 8
    return np.unique(np.concatenate([before & ((1 << (8 * k)) - 1) | (k << (8 * order)) for k in range(order + 1)]))


def packed(grams: dict[str, tuple[np.ndarray, np.ndarray]], symbols: int, limit: int = TABLE_BYTES) -> list[list[str]]:
    """Languages in sorted order, cut into runs whose tables take at most ``limit`` bytes each (one language at least)."""
    out: list[list[str]] = []
    held = np.zeros(0, np.int64)
    for lang in sorted(grams):
        own = contexts_of(grams[lang][0])
        union = np.union1d(held, own)
        if not out or len(union) * symbols * (len(out[-1]) + 1) * 4 > limit:
            out.append([lang])
            held = own
        else:
            out[-1].append(lang)
            held = union
    return out


def remainder(column, divisor: int):
    """crc32 of a number as text, modulo ``divisor`` (null stays null)."""
    return F.crc32(column.cast("string").cast("binary")) % divisor


def predict_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     per_lang: int = TRAIN_DOCS_PER_LANG, block_langs: int = BLOCK_LANGS, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Language of every whole text; one row per input row, repeated rows included.

    Training uses only text and label of rows whose crc32(id) mod 4 is not 2 and
    whose label, text and id are not null, up to ``per_lang`` whole texts per
    label (a repeated id counts once); a prediction reads the text alone.  ``und`` with score 0 if the text
    is null or has no letter, or if there is nothing to learn from.  Ties take
    the first label in sorted order.  ``score`` is the posterior share of the best
    language under equal priors.  A null id stays null (``held_out`` false); an
    empty table gives no rows; other columns are ignored.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"))
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    labelled = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != "")
                           & F.col("doc_id").isNotNull() & ~held_out)
    labelled = labelled.select("doc_id", "lang", "text")
    labels = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    # counts of the sample: one stored table for each block of labels
    counts = [cut_lineage(training_counts(labelled.filter(F.col("lang").isin(labels[i:i + block_langs])), per_lang), "lang_counts")
              for i in range(0, len(labels), block_langs)]
    alphabet = bytes(sorted({r[0] for each in counts for r in each.select(F.pmod("gram", F.lit(256))).distinct().collect()}))
    rows = rows.select("doc_id", held_out.alias("held_out"), "text")
    tables = _tables(counts, alphabet, table_bytes)
    first, second = next(tables, None), next(tables, None)
    if second is not None:
        return _predict_in_passes(rows, chain([first, second], tables))
    shared = docs.sparkSession.sparkContext.broadcast(first)     # one table of TABLE_BYTES, or of one language

    def run(batches):
        models = shared.value
        for batch in batches:
            for part in byte_slices(batch, 2, 2 << 20):
                pred, score, rate = ["und"] * part.num_rows, [0.0] * part.num_rows, [0.0] * part.num_rows
                for i, lang, least, total, size in _scored(models, part.column(2).to_pylist()):
                    pred[i], score[i], rate[i] = lang, 1 / total, least / size
                yield arrow_batch(FIELDS, [part.column(0), part.column(1), pred, score, rate])

    return rows.mapInArrow(run, schema_of(FIELDS))


def _tables(counts: list[DataFrame], alphabet: bytes, table_bytes: int) -> Iterator[ContextModels]:
    """The frozen tables, one at a time; the driver holds one block's counts and one table."""
    for each in counts:
        grams = collected(each)
        for langs in packed(grams, len(alphabet) + 1, table_bytes):
            yield ContextModels(langs, [grams[x] for x in langs], others=alphabet)


def _scored(models: ContextModels | None, texts: list[str | None]):
    """For each text with a letter: position, best language, its bits, the sum of all languages' likelihoods over its own, bytes."""
    good = [i for i, t in enumerate(texts) if t and models is not None and LETTER.search(t)]
    if good:
        raw = [texts[i].encode() for i in good]
        bits = models.lengths(raw)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(good)), best]
        total = np.exp2(np.clip(least[:, None] - bits, -1000, 0)).sum(axis=1)
        for k, i in enumerate(good):
            yield i, models.langs[best[k]], float(least[k]), float(total[k]), len(raw[k])


def _predict_in_passes(rows: DataFrame, tables: Iterable[ContextModels]) -> DataFrame:
    """``FIELDS`` of ``rows`` (``doc_id, held_out, text``): one pass over the stored texts for each table."""
    context = rows.sparkSession.sparkContext
    # all passes read the same rows under the same numbers
    numbered = number_rows(rows, "row_no")
    fields = [("row_no", "bigint"), ("lang", "string"), ("least", "double"), ("total", "double"), ("size", "bigint")]
    passes = None
    for table in tables:
        shared = context.broadcast(table)

        def run(batches, shared=shared):
            models = shared.value
            for batch in batches:
                for part in byte_slices(batch, 1, 2 << 20):
                    found = list(_scored(models, part.column(1).to_pylist()))
                    at, *columns = zip(*found) if found else [()] * 5
                    yield arrow_batch(fields, [part.column(0).take(pa.array(at, pa.int64())), *columns])

        done = cut_lineage(numbered.select("row_no", "text").mapInArrow(run, schema_of(fields)), "lang_pass")
        shared.destroy()
        passes = done if passes is None else passes.unionByName(done)
    # one row a block; ties take the first label
    best = passes.groupBy("row_no").agg(
        F.min(F.struct("least", "lang", "size")).alias("best"), F.collect_list(F.struct("least", "total")).alias("all"))
    share = F.aggregate("all", F.lit(0.0), lambda acc, x: acc + x["total"] * F.pow(
        F.lit(2.0), F.greatest(F.col("best.least") - x["least"], F.lit(-1000.0))))
    best = best.select("row_no", F.col("best.lang").alias("lang"), (1 / share).alias("score"),
                       (F.col("best.least") / F.col("best.size")).alias("rate"))
    zero = F.lit(0.0)
    return (numbered.drop("text").join(best, "row_no", "left")
            .select("doc_id", "held_out", F.coalesce("lang", F.lit("und")).alias("lang_pred"),
                    F.coalesce("score", zero).alias("score"), F.coalesce("rate", zero).alias("bits_per_byte")))

