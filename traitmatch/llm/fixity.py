"""WARC fixity audit with Merkle trees.

Every archived record has a digest and an offset range.  A tree's lowest nodes
hash the records of one id and one slice of the digests; the next levels
hash the slices of an id, runs of ids, then whole archives, then groups of archives
up to one root.  Above the ids a node also holds the offset range of its records and
hashes which of its children reach behind the start of the next one: the order of all
records of an archive is in its hashes, but no absolute offset.  So a lost or shortened
record, which moves all that follow it, changes the nodes above itself only, while records that
stand in another order are told as moved.  Two replicas are
compared root first; only the children of mismatching nodes are looked at on the
way down, to the damaged records and the ranges out of order.

Payloads never move: a record's digest and length are computed where it is
scanned, and everything behind that handles digests only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitmatch.llm.common import pick
from traitmatch.plans.lineage import cut_lineage

ARCHIVE_IDS = 1000         # id values per archive
RANGE = 1 << 16            # offsets per reported range
FAN = 64                   # nodes per node on the next three levels
ID_SLICES = FAN ** 2       # digest slices (lowest nodes) of one id
NULL_SLICES = FAN ** 3     # digest slices of the archive without id
ARCHIVE_FAN = 256          # archives per group, groups per group of groups; eight levels with the root
SLICE = 3                  # leading hex digits of a digest that cut the records of an id
COPY_BLOCK = 4096          # copies of a record written out at a time


def warc_record(url: Column, payload: Column) -> Column:
    """A WARC response record as text (UTF-8): header block, payload, closing blank lines."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def catalogue(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``archive, offset, length, page_id, digest`` of every page's record.

    An archive holds the records of ``ARCHIVE_IDS`` consecutive ids (one more
    archive those without id), ordered by id, then digest; offsets are running
    sums of record lengths.  One id, or no id, may hold any share of the rows: equal records are
    counted before the shuffle and told apart again at the end, in blocks, and an id's records are
    summed in slices of the digest.
    """
    p = pick(pages, page_id=id_col, url=url_col, payload=payload_col)
    record = warc_record(F.col("url"), F.col("payload"))
    rows = p.select(
        F.coalesce(F.floor(F.col("page_id") / ARCHIVE_IDS), F.lit(-1)).cast("bigint").alias("archive"),
        F.col("page_id").cast("bigint").alias("page_id"), F.octet_length(record).cast("bigint").alias("length"),
        F.sha2(record, 256).alias("digest"))
    records = (rows.groupBy("archive", "page_id", "length", "digest").agg(F.count(F.lit(1)).alias("copies"))
               .withColumn("slice", F.substring("digest", 1, SLICE)))
    bytes_ = F.sum(F.col("length") * F.col("copies"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # of an id 16 ** SLICE slices at most
    slices = (records.groupBy("archive", "page_id", "slice").agg(bytes_.alias("size"))
              .select(F.col("archive").alias("_a"), F.col("page_id").alias("_p"), F.col("slice").alias("_s"),
                      F.sum("size").over(earlier(Window.partitionBy("archive").orderBy("page_id", "slice"))).alias("base")))
    local = bytes_.over(earlier(Window.partitionBy("archive", "page_id", "slice").orderBy("digest", "length")))
    zero = F.lit(0).cast("bigint")
    placed = (records.withColumn("local", local)
              .join(slices, (F.col("archive") == F.col("_a")) & F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("slice") == F.col("_s")))
              .withColumn("start", F.coalesce("base", zero) + F.coalesce("local", zero)))
    # copies again, COPY_BLOCK at a time
    blocks = placed.withColumn("_from", F.explode(F.sequence(zero, F.col("copies") - 1, F.lit(COPY_BLOCK).cast("bigint"))))
    each = F.sequence(F.col("_from"), F.least(F.col("_from") + COPY_BLOCK, F.col("copies")) - 1)
    return (blocks.withColumn("_k", F.explode(each))
            .select("archive", (F.col("start") + F.col("_k") * F.col("length")).alias("offset"), "length", "page_id", "digest"))


def _up(name: str, by: int) -> Column:
    return F.floor(F.col(name) / by).cast("bigint")


def _parents(children: DataFrame, archive: Column, number: Column, ordered_ids: bool) -> DataFrame:
    """Parent nodes: the hash of the children's hashes in order, and their offset range.

    With ``ordered_ids`` the children hold whole ids, in the order that their archive has: ``behind`` lists the
    children that reach behind the start of the next one, and is hashed too.
    """
    listed = F.array_sort(F.collect_list(F.struct("archive", "number", "hash", "first", "last")))
    grouped = (children.withColumns({"_a": archive, "_n": number}).groupBy("side", "_a", "_n")
               .agg(listed.alias("_c"), F.min("first").alias("first"), F.max("last").alias("last")))
    after = lambda i: F.get("_c", i + 1)["first"]
    behind = F.array_join(F.transform(F.filter(F.transform("_c", lambda c, i: F.when(
        (c["archive"] >= 0) & (c["last"] > after(i)), c["number"])), lambda x: x.isNotNull()), lambda x: x.cast("string")), ",")
    hashes = F.array_join(F.transform("_c", lambda c: F.concat_ws(":", c["number"], c["hash"])), ",")
    return (grouped.withColumn("behind", behind if ordered_ids else F.lit(""))
            .select("side", F.col("_a").alias("archive"), F.col("_n").alias("number"),
                    F.sha2(F.concat_ws("|", hashes, F.nullif("behind", F.lit(""))), 256).alias("hash"), "first", "last", "behind"))


def _parent_keys() -> list[tuple[Column, Column]]:
    """Archive and number of the parent of a record, and of a node at levels 0 to 6."""
    zero = F.lit(0).cast("bigint")
    within = [(F.col("archive"), _up("number", by)) for by in (1, FAN, FAN, FAN)]
    return [*within, (F.col("archive"), zero),
            (_up("archive", ARCHIVE_FAN), zero), (_up("archive", ARCHIVE_FAN), zero), (zero, zero)]


# levels whose nodes' children are whole ids, or runs of ids, of one archive
ORDERED_LEVELS = (3, 4)


def _slot() -> Column:
    """Number of a record's lowest node in its archive: by id and digest, whatever its offset."""
    slice_of = lambda n: F.pmod(F.xxhash64("digest"), F.lit(n))
    place = F.pmod(F.col("page_id"), F.lit(ARCHIVE_IDS)) * ID_SLICES + slice_of(ID_SLICES)
    return F.coalesce(place, slice_of(NULL_SLICES)).cast("bigint")


def merkle_levels(records: DataFrame) -> list[DataFrame]:
    """``side, archive, number, hash, first, last, behind`` of the nodes, one stored table per level, from slices to the root.

    ``records`` has ``side, archive, offset, length, page_id, digest``; equal records count
    as one with a number of copies.  What one row gathers is bounded by the fan-out,
    and in a lowest node by the share of its slice in the distinct records of one id
    (or of those without id); the root has one child for each 65,536 archives.
    """
    below = (records.withColumn("number", _slot()).groupBy("side", "archive", "number", "page_id", "length", "digest")
             .agg(F.count(F.lit(1)).alias("copies"), F.min("offset").alias("first"),
                  F.max(F.col("offset") + F.col("length")).alias("last"))
             .select("side", "archive", "number", F.concat_ws(":", "page_id", "length", "digest", "copies").alias("hash"),
                     "first", "last"))
    levels = []
    for k, (archive, number) in enumerate(_parent_keys()):
        below = cut_lineage(_parents(below, archive, number, k in ORDERED_LEVELS), f"merkle_{k}")
        levels.append(below)
    return levels


def mismatching_ranges(levels: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``archive, number`` of the lowest nodes that differ between the sides ``p`` and ``r``; and
    ``archive, run, level, first, last`` of the nodes whose children may stand in another order in ``r``.

    Descends from the root: a level is joined with the mismatching nodes above it,
    so subtrees with equal hashes are never looked at.
    """
    side = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    differing = lambda nodes: (nodes.groupBy("archive", "number")
                               .agg(side("p", "hash").alias("_p"), side("r", "hash").alias("_r"),
                                    side("p", "behind").alias("_pb"), side("r", "behind").alias("_rb"),
                                    side("p", "first").alias("first"), side("p", "last").alias("last"))
                               .filter(~F.col("_p").eqNullSafe(F.col("_r"))))
    keys = _parent_keys()
    bad, moved = differing(levels[-1]), None
    for level in range(len(levels) - 2, -1, -1):
        archive, number = keys[level + 1]
        marked = bad.select(F.col("archive").alias("_a"), F.col("number").alias("_n"))
        bad = differing(levels[level].withColumns({"_a": archive, "_n": number})
                        .join(marked, ["_a", "_n"], "left_semi"))
        if level in ORDERED_LEVELS:
            here = bad.filter(F.col("_pb") != F.col("_rb")).select(                      # on both sides
                "archive", F.col("number").alias("run"), F.lit(level).alias("level"), "first", "last")
            moved = here if moved is None else moved.unionByName(here)
    return bad.select("archive", "number"), moved


def out_of_order(suspects: DataFrame, sides: DataFrame, same: list[str]) -> DataFrame:
    """The suspected nodes whose records that both sides hold stand in another order in ``r``.

    A record that is altered, extra or lost may reach behind its neighbours without any other being
    moved, so only equal records are looked at, and only in suspected archives: the offset range of each
    id, then of each run of ids, against the next one's.
    """
    there = suspects.select("archive").distinct()
    copies = (sides.join(there, "archive", "left_semi").withColumn("_n", F.row_number().over(
        Window.partitionBy("side", *same).orderBy("offset"))))
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("offset")))
    ids = (copies.groupBy(*same, "_n").agg(side("p").alias("_p"), side("r").alias("_r")).filter("_p is not null and _r is not null")
           .groupBy("archive", "page_id").agg(F.min("_r").alias("a"), F.max(F.col("_r") + F.col("length")).alias("b"))
           .withColumn("run", F.floor(F.pmod("page_id", F.lit(ARCHIVE_IDS)) / FAN).cast("bigint")))
    behind = lambda rows, keys, order: (rows.withColumn(
        "_next", F.lead("a").over(Window.partitionBy(*keys).orderBy(order))).filter("b > _next").select(*keys).distinct())
    runs = ids.groupBy("archive", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    low, high = ORDERED_LEVELS
    found = (behind(ids, ["archive", "run"], "page_id").withColumn("level", F.lit(low))
             .unionByName(behind(runs, ["archive"], "run").select("archive", F.lit(0).cast("bigint").alias("run"), F.lit(high).alias("level"))))
    return suspects.join(found, ["archive", "run", "level"], "left_semi")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Damaged records between two replicas of ``archive, offset, length, page_id, digest`` records.

    One row per record that
    differs: ``status`` is ``altered``, ``missing`` (not in the replica) or
    ``extra`` (not in the primary).  And one row, ``moved``, for each range of the primary (64 ids of an
    archive, or the 64-id ranges of an archive among themselves) whose records stand in another
    order in the replica, with the range's offsets and no record.  Equal replicas, also two empty ones, give no
    rows.  Records are paired by archive and id, not by offset, which may differ
    in every record behind a lost or shortened one: equal records first, copy by
    copy, then the remaining ones of an id in the order of their offsets (which of
    several altered records of one id belong together is not known otherwise).
    ``offset`` and ``length`` are the primary's, or the replica's of an extra
    record.  A null id is kept.
    """
    sides = (primary.withColumn("side", F.lit("p"))
             .unionByName(replica.select(*primary.columns).withColumn("side", F.lit("r"))))
    ranges, suspects = mismatching_ranges(merkle_levels(sides))
    inside = sides.withColumn("number", _slot()).join(ranges, ["archive", "number"], "left_semi")
    numbered = lambda df, *keys: df.withColumn("_n", F.row_number().over(
        Window.partitionBy("side", *keys).orderBy("offset", "length", "digest")))
    record = F.struct("offset", "length", "digest")
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("record")))
    same = ["archive", "page_id", "length", "digest"]
    alone = (numbered(inside, *same).withColumn("record", record).groupBy(*same, "_n")
             .agg(F.max("side").alias("side"), F.count(F.lit(1)).alias("sides"), F.max("record.offset").alias("offset"))
             .filter("sides = 1"))
    found = (numbered(alone, "archive", "page_id").withColumn("record", record).groupBy("archive", "page_id", "_n")
             .agg(side("p").alias("p"), side("r").alias("r")))
    status = (F.when(F.col("r").isNull(), "missing").when(F.col("p").isNull(), "extra").otherwise("altered"))
    start = F.floor(F.coalesce("p.offset", "r.offset") / RANGE).cast("bigint") * RANGE
    none = F.lit(None)
    moved = out_of_order(suspects, sides, same).select(
        "archive", F.col("first").alias("offset"), none.cast("bigint").alias("length"), none.cast("bigint").alias("page_id"),
        F.lit("moved").alias("status"), none.cast("string").alias("primary_digest"), none.cast("string").alias("replica_digest"),
        F.col("first").alias("range_start"), F.col("last").alias("range_end"))
    return found.select("archive", F.coalesce("p.offset", "r.offset").alias("offset"),
                        F.coalesce("p.length", "r.length").alias("length"), "page_id", status.alias("status"),
                        F.col("p.digest").alias("primary_digest"), F.col("r.digest").alias("replica_digest"),
                        start.alias("range_start"), (start + RANGE).alias("range_end")).unionByName(moved)


def damaged_copy(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``page_id, url, html`` of a replica: of each 97 consecutive ids, one has a character replaced, one is cut to half, one is lost."""
    p = pick(pages, page_id=id_col, url=url_col, html=payload_col)
    body, kind = F.coalesce("html", F.lit("")), F.pmod(F.col("page_id"), F.lit(97))
    half = F.floor(F.length(body) / 2).cast("int")
    damaged = (F.when(kind == 5, F.concat(F.substring(body, F.lit(1), half), F.lit("~"),
                                          F.substring(body, half + 2, F.length(body))))
               .when(kind == 31, F.substring(body, F.lit(1), half)).otherwise(F.col("html")))
    return p.filter(~kind.eqNullSafe(F.lit(64))).withColumn("html", damaged)


def audit_damaged_copy(pages: DataFrame) -> DataFrame:
    """Audit of all pages' archives against a replica with damage at fixed ids.

    Both sides are catalogued from their own rows: every record of the replica is
    hashed and has its own length and offset.
    """
    return audit(cut_lineage(catalogue(pages), "warc_primary"),
                 cut_lineage(catalogue(damaged_copy(pages)), "warc_replica"))


AUDIT_SQL = r"""
WITH p AS (
    SELECT page_id, coalesce(page_id // 1000, -1) AS archive, coalesce(url, '') AS url, coalesce(html, '') AS html,
           ((page_id % 97) + 97) % 97 AS kind FROM pages
), damaged AS (
    SELECT *, CASE kind WHEN 5 THEN left(html, length(html) // 2) || '~' || substring(html, length(html) // 2 + 2)
                        WHEN 31 THEN left(html, length(html) // 2) ELSE html END AS copy FROM p
), records AS (
    SELECT archive, page_id, kind,
           'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
           || chr(13) || chr(10) || 'Content-Type: application/http; msgtype=response' || chr(13) || chr(10)
           || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html
           || chr(13) || chr(10) || chr(13) || chr(10) AS rec,
           'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
           || chr(13) || chr(10) || 'Content-Type: application/http; msgtype=response' || chr(13) || chr(10)
           || 'Content-Length: ' || strlen(copy) || chr(13) || chr(10) || chr(13) || chr(10) || copy
           || chr(13) || chr(10) || chr(13) || chr(10) AS rep
    FROM damaged
), placed AS (
    SELECT archive, page_id, kind, strlen(rec) AS length, sha256(rec) AS primary_digest,
           CASE WHEN kind = 64 THEN NULL ELSE sha256(rep) END AS replica_digest,
           coalesce(sum(strlen(rec)) OVER (PARTITION BY archive ORDER BY page_id NULLS FIRST, sha256(rec)
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset"
    FROM records
)
SELECT CAST(archive AS BIGINT) AS archive, CAST("offset" AS BIGINT) AS "offset", length, page_id,
       CASE WHEN replica_digest IS NULL THEN 'missing' ELSE 'altered' END AS status, primary_digest, replica_digest,
       CAST("offset" // 65536 * 65536 AS BIGINT) AS range_start,
       CAST(("offset" // 65536 + 1) * 65536 AS BIGINT) AS range_end
FROM placed WHERE replica_digest IS DISTINCT FROM primary_digest
"""
