"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.llm.common import pick
from traitmatch.llm.langid import remainder


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, fold: int, held: int, max_rows: int) -> DataFrame:
    """``doc_id, y, text``: at most ``max_rows`` labelled documents outside the held-out fold, one row an id.

    Ids are chosen by their hash.  An id with several labels takes the more frequent one
    (a tie: 1), one with several texts the text of the least digest, so that the sample does not depend on
    the order of rows.
    """
    marked = (pick(labels, _id="doc_id", y=label_col)
              .filter(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("_id"), fold) != held))
              .groupBy(F.col("_id").cast("bigint").alias("_id")).agg((F.avg("y") >= 0.5).cast("int").alias("y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    # bounded by max_rows rows of two numbers
    joined = docs.join(F.broadcast(marked), docs["doc_id"] == marked["_id"]).select("doc_id", "y", "text")

    def least(batches):
        held: dict[int, tuple] = {}                      # at most max_rows texts
        for batch in batches:
            for doc_id, y, text in zip(*(c.to_pylist() for c in batch.columns)):
                digest = hashlib.sha256((text or "").encode("utf-8", "surrogatepass")).digest()
                if doc_id not in held or digest < held[doc_id][1]:
                    held[doc_id] = (y, digest, text or "")
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array([h[0] for h in held.values()], pa.int32()),
             pa.array([h[1] for h in held.values()], pa.binary()), pa.array([h[2] for h in held.values()], pa.string())],
            names=["doc_id", "y", "digest", "text"])

    one = joined.mapInArrow(least, "doc_id bigint, y int, digest binary, text string")
    return (one.groupBy("doc_id").agg(F.min(F.struct("digest", "y", "text")).alias("_one"))
            .select("doc_id", "_one.y", "_one.text"))
