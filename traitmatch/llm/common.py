"""Helpers shared by the text operators: column picking, Arrow mapping, byte-balanced slices."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text bytes that one Python call handles at a time (a longer single text is still taken whole).
SLICE_BYTES = 8 << 20
STAGE_SLICE_BYTES = 2 << 20     # the same in a stage beside others (``hand_back``)

ARROW_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
               "boolean": pa.bool_(), "binary": pa.binary()}


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select ``out=source`` columns by position, so that other columns of any
    name (repeated, or differing only in case) never make a reference ambiguous.

    An exact name wins over one that differs in case; the first of several equal
    names is taken.  A missing column raises ``ValueError``.
    """
    names = list(df.columns)
    lowered = [n.lower() for n in names]
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    out = []
    for alias, source in columns.items():
        if source in names:
            at = names.index(source)
        elif source.lower() in lowered:
            at = lowered.index(source.lower())
        else:
            raise ValueError(f"no column {source!r} among {names}")
        out.append(F.col(f"_c{at}").alias(alias))
    return plain.select(*out)


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id bigint, text string)``; only these two columns are scanned."""
    return pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                                         F.col("text").cast("string").alias("text"))


def byte_slices(batch: pa.RecordBatch, text_at: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding about ``limit`` text bytes each (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def schema_of(fields: Sequence[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields)


def arrow_batch(fields: Sequence[tuple[str, str]], columns: Sequence) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=ARROW_TYPES[t])
              for (_, t), c in zip(fields, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def release_memory() -> None:
    """Hand freed memory of this process back to the system (Arrow's pool, then the C heap where it can)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):         # another C library
        pass


def tidy(run: Callable, forget: Sequence[Callable] = ()) -> Callable:
    """``run`` for ``mapInArrow``, handing memory back at the end of each task: workers are used again, and
    what one stage freed must not stand beside what the next one needs.  ``forget`` names cached loaders
    whose tables no other stage reads."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            for loader in forget:
                loader.cache_clear()
            release_memory()

    return tidied


def map_texts(df: DataFrame, make: Callable, args: tuple, fields: Sequence[tuple[str, str]],
              text_at: int = 1, hand_back: bool = False, forget: Sequence[Callable] = ()) -> DataFrame:
    """One output row per input row: all input columns but the text, then ``fields``.

    ``make(*args)`` returns, inside the Python worker, a function from a text
    (or None) to a tuple of field values.  Each row is computed on its own, so a
    lost executor only repeats its partitions.  ``hand_back`` is for one of several stages (see :func:`tidy`,
    also for ``forget``).
    """
    passed = [(f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields) if i != text_at]
    fields, forget = list(fields), tuple(forget)
    limit = STAGE_SLICE_BYTES if hand_back else SLICE_BYTES

    def run(batches):
        fn = make(*args)
        for batch in batches:
            for part in byte_slices(batch, text_at, limit):
                rows = [fn(t) for t in part.column(text_at).to_pylist()]
                kept = [part.column(i) for i in range(part.num_columns) if i != text_at]
                made = list(zip(*rows)) if rows else [()] * len(fields)
                yield arrow_batch([*passed, *fields], [*kept, *made])

    return df.mapInArrow(tidy(run, forget) if hand_back else run, schema_of([*passed, *fields]))
