"""N-gram Jaccard join with signature trees.

Two texts link when the Jaccard similarity of their sets of 3-word shingles is at
least 0.9; the result names each text's component of linked texts.

1. Each text becomes its sorted set of 64-bit shingle hashes.  Texts with equal
   sets (a 128-bit digest) collapse to one representative.
2. Exact candidate blocking.  Linked sets of sizes s1 <= s2 differ in at most
   d = (s1 + s2) / 19 shingles.  The hash range is cut into k > d equal parts, so
   linked sets agree in at least k - d whole parts; texts that share the hash of
   one whole part (for the same size level) are candidates.  Parts with at most
   one shingle are left out while the spare parts allow it, which keeps unrelated
   texts apart without losing a link.
3. Candidates that hang together form groups.  A group is joined by signature
   trees: nodes hold the OR of their texts' shingle bitmaps and their size range,
   and a dual traversal drops pairs of nodes whose largest possible overlap is too
   small, or whose texts are already connected.  What remains is verified on the
   exact hash sets.
4. A group beyond a size first has each text verified against one leader, the text
   it shares most signatures with.  The classes that come of it are cut into
   blocks, and pairs of blocks are joined in their own tasks.  Blocks of one class
   are never paired, so copies of one text, however many, are read once for each
   block of texts outside their class; memory is bounded and no link is lost.
5. The links (a spanning forest of each group, never all its pairs) give the
   components.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitmatch.llm.common import byte_slices, texts_of, tidy
from traitmatch.llm.components import connected_components
from traitmatch.plans.lineage import cut_lineage, number_rows, scratch_scope

SHINGLE = 3
GROUP_SHINGLES = 4_000_000     # most shingle hashes (8 bytes each) that one joining task holds
LEAF, FAN = 16, 4

# Similarity 0.9 as integers: linked sets share I >= 9 (s1 + s2) / 19 shingles.
LEVELS = [9]
while LEVELS[-1] < 1 << 31:
    LEVELS.append(LEVELS[-1] * 3 // 2)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift and multiply by odd constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 3-word shingles (A-Z lower-cased); fewer words make one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    if len(h) < SHINGLE:
        code = mix(h[:1]) + np.uint64(len(h))
        for x in h[1:]:
            code = mix(code + x)
        return mix(code)
    return np.unique(mix(mix(mix(h[:-2]) + h[1:-1]) + h[2:]))


def set_digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 90 * (len(a) + len(b) - both)


def level_signatures(hashes: np.ndarray, level: int) -> np.ndarray:
    """Hashes of the whole parts of a set, for pairs whose smaller size lies in ``level``."""
    high = LEVELS[level + 1] - 1
    differ = (high + high * 10 // 9) // 19
    spare = 1 + differ // 16
    k = differ + 1 + spare
    part = (hashes >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)
    edges = np.searchsorted(part, np.arange(k + 1, dtype=np.uint64))
    running = np.append(np.uint64(0), np.cumsum(mix(hashes)))
    counts = np.diff(edges)
    sums = running[edges[1:]] - running[edges[:-1]]
    place = mix(np.arange(k, dtype=np.uint64) + np.uint64(level << 40))
    signature = mix(mix(sums) + place + counts.astype(np.uint64))
    weak = counts <= 1
    return signature if weak.sum() > spare else signature[~weak]


def signatures(hashes: np.ndarray) -> np.ndarray:
    """All signatures of a set; sets under nine shingles link only if equal and have none."""
    n = len(hashes)
    if n < LEVELS[0]:
        return np.zeros(0, np.uint64)
    level = bisect_right(LEVELS, n) - 1
    own = level_signatures(hashes, level)
    # a smaller partner has at least 9n/10 shingles and may belong to the level below
    if level and -(-9 * n // 10) < LEVELS[level]:
        return np.concatenate([own, level_signatures(hashes, level - 1)])
    return own


SET_SCHEMA = "doc_id bigint, n_shingles bigint, set_hash binary, signatures binary"


def shingle_sets(docs: DataFrame) -> DataFrame:
    """Size, digest (null for an empty set) and packed signatures of every text."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1):
                sizes, digests, packed = [], [], []
                for text in part.column(1).to_pylist():
                    s = shingle_set(text)
                    sizes.append(len(s))
                    digests.append(set_digest(s) if len(s) else None)
                    packed.append(signatures(s).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(packed, pa.binary())], names=["doc_id", "n_shingles", "set_hash", "signatures"])

    return docs.mapInArrow(tidy(run), SET_SCHEMA)


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``signature, a, b``: one row per distinct signature of a batch, with its least text ``a``.

    Further texts of the batch with the signature hang on that one (``b``) and go no
    further, so a signature shared by many texts is pre-aggregated before the shuffle.
    """
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        packed = batch.column(1).to_pylist()
        flat = np.concatenate([np.frombuffer(packed[i], np.uint64) for i in order] or [np.zeros(0, np.uint64)])
        node = np.repeat(ids[order], [len(packed[i]) // 8 for i in order])
        by = np.argsort(flat, kind="stable")
        flat, node = flat[by], node[by]
        if not len(flat):
            continue
        first = np.append(True, flat[1:] != flat[:-1])
        lead = node[np.flatnonzero(first)[np.cumsum(first) - 1]]
        edge = ~first & (node != lead)
        for start in range(0, len(flat), 1 << 17):
            cut = slice(start, start + (1 << 17))
            keep = first[cut] | edge[cut]
            # an edge travels under a key of its own text, not under the (possibly very common) signature
            key = np.where(first[cut], flat[cut], mix(node[cut].astype(np.uint64)))[keep].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(node[cut][keep]),
                 pa.array(lead[cut][keep], mask=first[cut][keep])], names=["signature", "a", "b"])


def candidate_edges(representatives: DataFrame) -> DataFrame:
    """``(a, b, n)``: a text, a lesser one, and for how many signatures that one leads the batch or all texts."""
    rows = representatives.select("doc_id", "signatures").mapInArrow(tidy(_signature_rows), "signature bigint, a bigint, b bigint")
    same = Window.partitionBy("signature", F.col("b").isNull())
    lead = F.coalesce(F.col("b"), F.min("a").over(same))
    return (rows.select("a", lead.alias("b")).filter(F.col("a") != F.col("b"))
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))


class SignatureTree:
    """Bitmaps, OR-combined upward, over texts ordered by set size."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.bitmaps = np.zeros((len(sets), bits // 64), np.uint64)
        for i, s in enumerate(sets):
            at = s & np.uint64(bits - 1)
            np.bitwise_or.at(self.bitmaps[i], (at >> np.uint64(6)).astype(np.int64),
                             np.uint64(1) << (at & np.uint64(63)))
        # shingles that fall on a bit another one has set: overlap <= common bits + this
        self.excess = self.sizes - np.bitwise_count(self.bitmaps).sum(axis=1).astype(np.int64)
        # levels of nodes, from leaves to the root: (first text, bitmap, least size, most excess)
        self.levels = [self._level(np.arange(0, len(sets), LEAF))]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(self._level(self.levels[-1][0][::FAN]))

    def _level(self, first: np.ndarray):
        last = np.append(first[1:], len(self.sets)) - 1
        return (first, np.bitwise_or.reduceat(self.bitmaps, first, axis=0), self.sizes[first], self.sizes[last],
                np.maximum.reduceat(self.excess, first), last + 1)


def may_link(bits_a, low_a, high_a, excess_a, bits_b, low_b, high_b, excess_b) -> np.ndarray:
    """Matrix: whether some text under a node of A and one of B can overlap enough."""
    common = np.bitwise_count(bits_a[:, None, :] & bits_b[None, :, :]).sum(axis=2).astype(np.int64)
    most = np.minimum(common + np.minimum(excess_a[:, None], excess_b[None, :]),
                      np.minimum(high_a[:, None], high_b[None, :]))
    return 19 * most >= 9 * (low_a[:, None] + low_b[None, :])


def tree_join(left: list[np.ndarray], right: list[np.ndarray] | None = None,
              classes: list[int] | None = None) -> list[tuple[int, int]]:
    """Links between ``left`` and ``right`` (or within ``left``) that form a spanning forest.

    Positions count through ``left``, then ``right``; sets are sorted and distinct.
    Texts of one class (an entry per position) are known to be connected already.
    """
    n = len(left)
    sets = [*left, *(right or [])]
    if len(sets) < 2 or not left or (right is not None and not right):
        return []
    bits = 256
    while bits < 2 * max(map(len, sets)) and bits < 1 << 14:
        bits *= 2
    order_a = sorted(range(n), key=lambda i: len(left[i]))
    a = SignatureTree([left[i] for i in order_a], bits)
    if right is None:
        b, order_b = a, order_a
    else:
        order_b = sorted(range(len(right)), key=lambda i: len(right[i]))
        b = SignatureTree([right[i] for i in order_b], bits)
        order_b = [n + i for i in order_b]
    # component labels of texts in tree order (one array if the trees are one)
    label = np.arange(len(sets)) if classes is None else np.unique(classes, return_inverse=True)[1]
    label_a = label[order_a]
    label_b = label_a if right is None else label[order_b]
    links: list[tuple[int, int]] = []

    def connected(ra, rb) -> bool:
        x = label_a[ra[0]]
        return bool((label_a[ra[0]:ra[1]] == x).all() and (label_b[rb[0]:rb[1]] == x).all())

    def leaves(ra, rb):
        ia, ib = np.arange(*ra), np.arange(*rb)
        ok = may_link(a.bitmaps[ia], a.sizes[ia], a.sizes[ia], a.excess[ia],
                      b.bitmaps[ib], b.sizes[ib], b.sizes[ib], b.excess[ib])
        if right is None and ra == rb:
            ok &= ia[:, None] < ib[None, :]
        for i, j in zip(*np.nonzero(ok)):
            i, j = int(ia[i]), int(ib[j])
            x, y = label_a[i], label_b[j]
            if x != y and linked(a.sets[i], b.sets[j]):
                links.append((order_a[i], order_b[j]))
                label_a[label_a == y] = x
                if right is not None:
                    label_b[label_b == y] = x

    def node(tree, level, i):
        first, bitmap, low, high, excess, end = tree.levels[level]
        return int(first[i]), int(end[i])

    def children(tree, level, i):
        if level == 0:
            return 0, np.array([i])
        return level - 1, np.arange(i * FAN, min((i + 1) * FAN, len(tree.levels[level - 1][0])))

    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        ra, rb = node(a, la, i), node(b, lb, j)
        if connected(ra, rb):
            continue
        if la == 0 and lb == 0:
            leaves(ra, rb)
            continue
        ka, ca = children(a, la, i) if la >= lb else (la, np.array([i]))
        kb, cb = children(b, lb, j) if lb >= la else (lb, np.array([j]))
        na, nb = a.levels[ka], b.levels[kb]
        ok = may_link(na[1][ca], na[2][ca], na[3][ca], na[4][ca], nb[1][cb], nb[2][cb], nb[3][cb], nb[4][cb])
        for x, y in zip(*np.nonzero(ok)):
            if right is None and la == lb and i == j and ca[x] > cb[y]:
                continue                      # the mirrored pair is visited
            stack.append((ka, int(ca[x]), kb, int(cb[y])))
    return links


def _join_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (component, i, j) -> links.  One pair of blocks is held at a time."""
    key, members = None, []

    def close():
        _, i, j = key
        seen, left, right = set(), [], []
        for doc_id, block, known, digest, text in members:
            if (doc_id, digest) in seen:
                continue
            hashes = shingle_set(text)
            if set_digest(hashes) == digest:      # another row may carry the same id with another text
                seen.add((doc_id, digest))
                (left if block == i else right).append((doc_id, hashes, known))
        found = tree_join([s for _, s, _ in left], [s for _, s, _ in right] if i != j else None,
                          [c for _, _, c in left + right])
        ids = [d for d, _, _ in left + right]
        return [(ids[x], ids[y]) for x, y in found]

    def batch_of(links):
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()),
                                           pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    links: list[tuple[int, int]] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
        for group, i, j, doc_id, block, known, digest, text in zip(*columns):
            if (group, i, j) != key:
                if members:
                    links += close()
                key, members = (group, i, j), []
                if len(links) > 10_000:
                    yield batch_of(links)
                    links = []
            members.append((doc_id, block, known, digest, text))
    if members:
        links += close()
    if links:
        yield batch_of(links)


PLACE = ["component", "i", "j", "doc_id", "block", "class", "set_hash"]


def links_of_blocks(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Links between blocks ``i`` and ``j`` of a component; ``rows`` has ``PLACE``, texts come from ``docs``."""
    keys = PLACE[:3]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.join(docs, "doc_id").select(*PLACE, "text").repartition(n, *keys).sortWithinPartitions(*keys)
            .mapInArrow(tidy(_join_groups), "a bigint, b bigint"))


def leader_rows(large: DataFrame, edges: DataFrame, group_shingles: int) -> DataFrame:
    """``PLACE`` of the texts of large groups, each with one leader: the text it shares most signatures with.

    A leader is block 0; its followers are cut into blocks of about ``group_shingles``,
    each in a task of its own with the leader.
    """
    leads = edges.groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("component"))
    followers = large.drop("component").join(leads, F.col("doc_id") == F.col("a")).drop("a")
    cuts = (followers.groupBy("component").agg(F.sum("n_shingles").alias("total"))
            .select("component", F.ceil(F.col("total") / group_shingles).alias("cuts")))
    block = F.pmod(F.xxhash64("doc_id"), F.col("cuts")) + 1
    follows = (followers.join(cuts, "component").withColumn("block", block.cast("string"))
               .select("component", F.lit("0").alias("i"), F.col("block").alias("j"), "doc_id", "block",
                       F.col("doc_id").alias("class"), "set_hash"))
    lead = (cuts.join(large.select("doc_id", "set_hash"), F.col("component") == F.col("doc_id"))
            .select("component", F.lit("0").alias("i"), F.explode(F.sequence(F.lit(1), F.col("cuts")).cast("array<string>")).alias("j"),
                    "doc_id", F.lit("0").alias("block"), F.col("doc_id").alias("class"), "set_hash"))
    return follows.unionByName(lead)


def block_rows(large: DataFrame, classes: DataFrame, group_shingles: int) -> DataFrame:
    """``PLACE`` of large groups: a row for every pair of blocks that holds the text.

    A class of more than half ``group_shingles`` has its own blocks, which are
    paired with all blocks of other classes; the remaining classes share pooled
    blocks, which are also paired with each other and joined within.  A block
    number that no text hashes to is paired with nothing.
    """
    half = group_shingles / 2
    classed = (large.join(classes.select(F.col("node").alias("doc_id"), F.col("component").alias("class")), "doc_id", "left")
               .withColumn("class", F.coalesce("class", "doc_id")))
    sizes = classed.groupBy("component", "class").agg(F.sum("n_shingles").alias("size"))
    kind = F.when(F.col("size") > half, F.col("class").cast("string")).otherwise("pool")
    sizes = sizes.withColumn("kind", kind)
    kinds = (sizes.groupBy("component", "kind").agg(F.sum("size").alias("total"))
             .select("component", "kind", F.ceil(F.col("total") / half).cast("int").alias("blocks")))
    # a pooled class stays whole in its block
    spread = F.when(F.col("kind") == "pool", F.xxhash64("class")).otherwise(F.xxhash64("doc_id"))
    blocked = (classed.join(sizes.drop("size"), ["component", "class"]).join(kinds, ["component", "kind"])
               .withColumn("block", F.concat_ws(":", "kind", F.pmod(spread, F.col("blocks")))).drop("blocks"))
    # only blocks that hold a text; one row gathers the block names of a kind, not its texts
    held = (blocked.groupBy("component", "kind").agg(F.collect_set("block").alias("_blocks"))
            .withColumnsRenamed({"component": "_c", "kind": "_kind"}))
    pairs = kinds.drop("blocks").join(held, (F.col("component") == F.col("_c"))
                                      & ((F.col("kind") != F.col("_kind")) | (F.col("kind") == "pool"))).drop("_c")
    return (blocked.join(pairs, ["component", "kind"]).withColumn("_other", F.explode("_blocks"))
            .withColumns({"i": F.least("block", "_other"), "j": F.greatest("block", "_other")}).select(*PLACE))


def verified_links(docs: DataFrame, representatives: DataFrame, groups: DataFrame, edges: DataFrame,
                   group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """Links within candidate groups: ``groups`` has ``node, component``, ``edges`` the candidates behind them."""
    members = (groups.withColumnRenamed("node", "doc_id")
               .join(representatives.select("doc_id", "set_hash", "n_shingles"), "doc_id"))
    totals = members.groupBy("component").agg(F.sum("n_shingles").alias("total"))
    members = cut_lineage(members.join(totals, "component"), "jaccard_members")
    whole, large = (members.filter(F.col("total") <= group_shingles),
                    members.filter(F.col("total") > group_shingles).drop("total"))
    only = F.lit("0")
    rows = whole.select("component", only.alias("i"), only.alias("j"), "doc_id", only.alias("block"),
                        F.col("doc_id").alias("class"), "set_hash")
    led = cut_lineage(links_of_blocks(docs, leader_rows(large, edges, group_shingles)), "jaccard_led")
    rows = rows.unionByName(block_rows(large, connected_components(led), group_shingles))
    return links_of_blocks(docs, rows).unionByName(led)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per input row.

    ``component_id`` is the least id reachable by links, itself included.  A null
    or wordless text has an empty set and is linked with nothing (its component is
    its own id).  Equal texts are linked (repeated rows too: each gets its row).
    Rows with one id but different texts count as one node.  A row without id
    takes the component of an equal text with an id, else null.  An empty table
    gives no rows; other columns are ignored.
    """
    texts = texts_of(docs, id_col, text_col)
    with scratch_scope(docs.sparkSession):
        sets = cut_lineage(shingle_sets(texts), "shingle_sets", outlive=True)
        named = sets.filter(F.col("set_hash").isNotNull() & F.col("doc_id").isNotNull())
        representatives = cut_lineage(named.groupBy("set_hash", "n_shingles").agg(F.min("doc_id").alias("doc_id")),
                                      "shingle_reps")
        signed = (named.filter(F.octet_length("signatures") > 0)
                  .join(representatives.select("doc_id", "set_hash"), ["doc_id", "set_hash"], "left_semi"))
        edges = cut_lineage(candidate_edges(signed), "candidate_edges")
        links = verified_links(texts, representatives, connected_components(edges), edges, group_shingles)
        labels = connected_components(links)
        # stored, so that a join of the copies of one text with its row reads two plain shuffles, which AQE can split
        named_sets = cut_lineage(
            representatives.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .groupBy("set_hash").agg(F.min(F.coalesce("component", "doc_id")).alias("component")), "set_components",
            outlive=True)
    return (sets.select("doc_id", "n_shingles", "set_hash").join(named_sets, "set_hash", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """One row of each component, all columns unchanged: that of the least id.

    The join runs on row numbers, not ids, so repeated or missing ids never take
    another row along.  A row without id is kept only where no row of its component
    has one; among equal ids the first row is kept.  Texts without a shingle are
    linked with nothing and stay.
    """
    names = docs.columns
    numbered = number_rows(docs.toDF(*[f"_c{i}" for i in range(len(names))]))
    with scratch_scope(docs.sparkSession):
        found = jaccard_components(numbered, "_row", f"_c{names.index(text_col)}", group_shingles)
        ids = numbered.select("_row", F.col(f"_c{names.index(id_col)}").alias("_id"))
        order = F.struct(F.col("_id").isNull(), "_id", "_row")
        kept = (found.withColumnRenamed("doc_id", "_row").join(ids, "_row")
                .groupBy("component_id").agg(F.min(order).alias("_least")).select("_least._row"))
        # a plain stored table of numbers: the optimizer sees its bytes when it plans the join with the texts
        dropped = cut_lineage(ids.select("_row").join(kept, "_row", "left_anti"), "dropped_rows", outlive=True)
    return (numbered.join(dropped, "_row", "left_anti")
            .select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)]))


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, list_aggregate(w[i:i + 2], 'string_agg', ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b USING (s)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM common c JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * c.n >= 90 * (p.n + q.n - c.n)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sizes UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l USING (doc_id)
"""
