"""Benchmark decontamination over a distributed positional inverted index.

The index holds every token of the training texts.  It is cut into segments (some
thousand documents each, whole documents only): a segment row stores the sorted
term hashes, and for each term its sorted positions, packed as integers.  Building
needs no shuffle, a segment fits easily in a task, and any number of searches can
read the stored table.

A phrase search looks up all terms of a phrase, starts from the one with the
fewest postings in the segment, and intersects the offset-adjusted lists from the
rarest to the most frequent.  Terms are 64-bit hashes of words; a false phrase
match would need a collision in exactly the missing word's place.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.llm.common import byte_slices, pick, texts_of, tidy
from traitmatch.plans.lineage import cut_lineage, number_rows, scratch_scope

WINDOW = 13
SEGMENT_BYTES = 2 << 20      # text bytes per segment (a longer single text still makes one segment)
BLOCK_WORDS = 250_000        # query words per broadcast block (8 bytes each)
# Word characters: 0-9, letters, and everything beyond ASCII; A-Z become a-z, the rest blanks.
TO_WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32
                 for c in range(256))

INDEX_SCHEMA = ("segment bigint, doc_ids array<bigint>, starts binary, n_words binary, terms binary, "
                "ends binary, positions binary")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_WORDS).split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments of the positional index over all texts (stored as a table by the caller).

    Positions count words through the segment, with one position left out between
    documents, so that no phrase runs from one text into the next.
    """

    def segment(number, ids, words):
        counts = np.array(list(map(len, words)), np.int64)
        starts = np.cumsum([0, *(counts + 1)])[:-1]
        flat = hashes([w for each in words for w in each])
        at = np.arange(len(flat)) + np.repeat(np.arange(len(words)), counts)
        order = np.argsort(flat, kind="stable")
        terms, first = np.unique(flat[order], return_index=True)
        ends = np.append(first[1:], len(flat)) if len(flat) else first
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
             *(pa.array([x.tobytes()], pa.binary()) for x in (
                 starts.astype(np.int64), counts.astype(np.int64), terms, ends.astype(np.int64),
                 at[order].astype(np.uint32)))],
            names=["segment", "doc_ids", "starts", "n_words", "terms", "ends", "positions"])

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, words, held = [], [], 0
        for batch in batches:
            for part in byte_slices(batch, 1, SEGMENT_BYTES):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids.append(doc_id)
                    words.append(words_of(text))
                    held += len(text or "")
                    if held >= SEGMENT_BYTES:
                        yield segment(number, ids, words)
                        number, ids, words, held = number + 1, [], [], 0
        if ids:
            yield segment(number, ids, words)

    return texts_of(docs, id_col, text_col).mapInArrow(tidy(run), INDEX_SCHEMA)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one at a time: only one segment's integers are copied out at once."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


class Segment:
    """One row of the index."""

    def __init__(self, row: dict):
        self.number, self.doc_ids = row["segment"], row["doc_ids"]
        self.starts, self.n_words = np.frombuffer(row["starts"], np.int64), np.frombuffer(row["n_words"], np.int64)
        self.terms, self.ends = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["ends"], np.int64)
        self.positions = np.frombuffer(row["positions"], np.uint32)

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """Place of each term hash among the segment's terms, -1 where absent."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, number: int) -> np.ndarray:
        return self.positions[self.ends[number - 1] if number else 0:self.ends[number]].astype(np.int64)

    def phrase(self, numbers: np.ndarray) -> np.ndarray:
        """Start positions of the exact phrase: rarest list first, then offset-adjusted intersections."""
        counts = self.ends[numbers] - np.where(numbers > 0, self.ends[numbers - 1], 0)
        order = np.argsort(counts, kind="stable")
        found = self.postings(numbers[order[0]]) - order[0]
        for k in order[1:]:
            if not len(found):
                break
            found = found[is_in(found + k, self.postings(numbers[k]))]
        return found

    def near(self, numbers: np.ndarray, span: int) -> np.ndarray:
        """Positions of the rarest term with every other term at most ``span`` words away in the same text."""
        counts = self.ends[numbers] - np.where(numbers > 0, self.ends[numbers - 1], 0)
        order = np.argsort(counts, kind="stable")
        found = self.postings(numbers[order[0]])
        doc = self.doc_of(found)
        low = np.maximum(found - span, self.starts[doc])
        high = np.minimum(found + span, self.starts[doc] + self.n_words[doc] - 1)
        for k in order[1:]:
            other = self.postings(numbers[k])
            ok = np.searchsorted(other, low) < np.searchsorted(other, high, side="right")
            found, low, high = found[ok], low[ok], high[ok]
        return found

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1


def is_in(values: np.ndarray, sorted_list: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_list, values), len(sorted_list) - 1)
    return sorted_list[at] == values


def query_blocks(items: Iterable[tuple], limit: int = BLOCK_WORDS) -> Iterator[list[tuple[str, np.ndarray]]]:
    """Items as (id text, word hashes), in blocks of about ``limit`` words; items without id or words are left out."""
    block, held = [], 0
    for item_id, text in items:
        words = words_of(text)
        if item_id is None or not words:
            continue
        if block and held + len(words) > limit:
            yield block
            block, held = [], 0
        block.append((str(item_id), hashes(words)))
        held += len(words)
    if block:
        yield block


def windows_of(block, size: int = WINDOW) -> dict[int, tuple[np.ndarray, list[list[str]]]]:
    """Distinct windows by length, each with the ids of the items it stands in."""
    found: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = {}
    for item_id, words in block:
        k = min(size, len(words))
        for i in range(len(words) - k + 1):
            w = words[i:i + k]
            found.setdefault(k, {}).setdefault(w.tobytes(), (w, set()))[1].add(item_id)
    return {k: (np.stack([w for w, _ in d.values()]), [sorted(s) for _, s in d.values()]) for k, d in found.items()}


HIT_SCHEMA = "segment bigint, doc_no int, item string, first int, last int"


def search(index: DataFrame, items: DataFrame, size: int = WINDOW, span: int | None = None) -> DataFrame:
    """Matches of every item's windows: ``segment, doc_no, item, first, last`` (word numbers in the text).

    With ``span`` None, exact phrases; overlapping matches of one item are joined.
    With a ``span``, proximity matches: all words of a window within ``span`` words
    of its rarest one (``first`` = ``last`` = that word).  The items are read in
    blocks of bounded size; each block is broadcast and held against the whole index.
    """
    context = index.sparkSession.sparkContext
    parts = []
    for block in query_blocks(((r[0], r[1]) for r in items.toLocalIterator())):
        shared = context.broadcast(windows_of(block, size))

        def run(batches, shared=shared):
            for batch in batches:
                for row in rows_of(batch):
                    yield from _hits(Segment(row), shared.value, span)

        parts.append(index.mapInArrow(tidy(run), HIT_SCHEMA))
    if not parts:
        return index.sparkSession.createDataFrame([], HIT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _hits(segment: Segment, windows, span) -> Iterator[pa.RecordBatch]:
    rows: dict[tuple[int, str], list[np.ndarray]] = {}
    for k, (terms, owners) in windows.items():
        numbers = segment.numbers(terms)
        for w in np.flatnonzero((numbers >= 0).all(axis=1)):
            starts = segment.phrase(numbers[w]) if span is None else segment.near(np.unique(numbers[w]), span)
            if not len(starts):
                continue
            docs = segment.doc_of(starts)
            for doc in np.unique(docs):
                local = starts[docs == doc] - segment.starts[doc]
                for item in owners[w]:
                    rows.setdefault((int(doc), item), []).append(
                        np.column_stack([local, local + (k - 1 if span is None else 0)]))
    doc_no, item, first, last = [], [], [], []
    for (doc, name), spans in rows.items():
        spans = np.unique(np.concatenate(spans), axis=0)
        # join overlapping or adjacent matches of the item
        ends = np.maximum.accumulate(spans[:, 1])
        cut = np.append(0, np.flatnonzero(spans[1:, 0] > ends[:-1] + 1) + 1)
        last_of = np.append(cut[1:] - 1, len(spans) - 1)
        for a, b in zip(spans[cut, 0].tolist(), ends[last_of].tolist()):
            doc_no.append(doc)
            item.append(name)
            first.append(a)
            last.append(b)
    if doc_no:
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment.number] * len(doc_no), pa.int64()), pa.array(doc_no, pa.int32()),
             pa.array(item, pa.string()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
            names=["segment", "doc_no", "item", "first", "last"])


def index_documents(index: DataFrame) -> DataFrame:
    """``segment, doc_no, doc_id, n_words`` of every indexed row (only these columns are scanned)."""

    def run(batches):
        for batch in batches:
            for row in rows_of(batch):
                n = np.frombuffer(row["n_words"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["segment"]] * len(n), pa.int64()), pa.array(np.arange(len(n), dtype=np.int32)),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(n)],
                    names=["segment", "doc_no", "doc_id", "n_words"])

    return index.select("segment", "doc_ids", "n_words").mapInArrow(
        tidy(run), "segment bigint, doc_no int, doc_id bigint, n_words bigint")


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Hit words and matching items of every whole text, one row per input row (repeated rows included).

    ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``: a word is hit
    if it lies in an occurrence of a window; contaminated if 20 * n_hit >= n_words
    and n_hit > 0.  Null or empty texts have no words and no hits; items without
    id or words never match; items sharing an id count once; a null doc id stays
    null; empty tables give no rows or no hits; other columns are ignored.
    """
    index = cut_lineage(build_index(docs, id_col, text_col), "token_index")
    hits = search(index, pick(benchmark, item=item_col, text=item_text_col).select(
        F.col("item").cast("string"), F.col("text").cast("string")), size)
    spans = F.array_sort(F.collect_list(F.struct(F.col("first").alias("a"), F.col("last").alias("b"))))
    # words under the union of the spans, in order of their first word
    covered = F.aggregate(
        F.col("spans"), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["b"] - F.greatest(s["a"], acc["end"] + 1) + 1, F.lit(0))).alias("n"),
            F.greatest(acc["end"], s["b"]).alias("end")),
        lambda acc: acc["n"])
    per_doc = (hits.groupBy("segment", "doc_no")
               .agg(spans.alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
               .select("segment", "doc_no", covered.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                       F.concat_ws(",", "items").alias("items")))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("bigint")
    return (index_documents(index).join(per_doc, ["segment", "doc_no"], "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"),
                    F.coalesce(F.col("n_items"), F.lit(0)).cast("bigint").alias("n_items"),
                    F.sha2(F.coalesce(F.col("items"), F.lit("")), 256).alias("items_sha256"),
                    ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """The rows that are not contaminated, all columns unchanged.

    The search runs on row numbers, not ids, so repeated or missing ids never
    take another row along.  Null or wordless texts stay; an empty benchmark drops
    nothing; an empty table gives no rows.  The index is deleted once the dropped rows are known.
    """
    names = docs.columns
    numbered = number_rows(docs.toDF(*[f"_c{i}" for i in range(len(names))]))
    with scratch_scope(docs.sparkSession):
        found = find_contamination(numbered, benchmark, "_row", f"_c{names.index(text_col)}", item_col, item_text_col, size)
        bad = cut_lineage(found.filter("contaminated").select(F.col("doc_id").alias("_row")), "dropped_rows", outlive=True)
    return (numbered.join(bad, "_row", "left_anti")
            .select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)]))


# One row per document; the word table, the windows and the hits in plain SQL.
FIND_CONTAMINATION_SQL = r"""
WITH doc_words AS (
    SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word
    FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT k FROM item_windows
), doc_windows AS (
    SELECT doc_id, pos, k, phrase FROM (
        SELECT doc_id, pos, k, array_to_string(list(word) OVER (PARTITION BY doc_id, k ORDER BY pos
               ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)[1:k], ' ') AS phrase,
               count(*) OVER (PARTITION BY doc_id, k) - pos + 1 AS left_words
        FROM doc_words, lengths) WHERE left_words >= k
), found AS (
    SELECT d.doc_id, d.pos, d.k, i.item_id FROM doc_windows d JOIN item_windows i USING (k, phrase)
), hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
        SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (
        SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
), sizes AS (SELECT doc_id, count(*) AS n_words FROM doc_words GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n_words, 0) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= coalesce(s.n_words, 0) AS contaminated
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN hit h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""
