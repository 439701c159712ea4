"""SimHash near-dedup with a Gray-order hierarchical index (operator 10).

Fingerprints: 64-bit majority votes over the XXH64 values of a text's word shingles. Distinct
fingerprints that differ in at most ``max_bits`` bits are linked; documents are grouped by the
connected components of these links.

Search. Upper nodes of the index are masked bit patterns: two fingerprints within ``max_bits``
of each other agree on at least one of ``max_bits + 1`` bit blocks, so each fingerprint goes to
the groups of its block values. A group over ``max_group`` fingerprints is split the same way on
its free bits, again and again; a group with few free bits holds few distinct fingerprints, so
the splitting ends with bounded groups and nothing is dropped. Inside a group the fingerprints
are sorted by Gray rank, consecutive ones are factored into nodes that hold the bits they share,
and whole nodes are pruned by the differences accumulated from the root. Each group reports a
spanning forest of its links, so output stays linear where all members are linked.

Defined results: a null, empty or wordless text has fingerprint zero and is linked like any
other; a text shorter than a shingle is one shingle; null ``doc_id``s are ignored when the
smallest id of a component is taken (null where there is no other); repeated rows share their
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tallyrisk.llm.common import guarded, map_arrow, materialize, project_columns

SHINGLE = 3
MAX_BITS = 3
MAX_GROUP = 1024
VOTES = 1 << 16           # shingles whose bits are counted at once
LEAF, FANOUT = 8, 8
FULL = (1 << 64) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(len(words) - shingle + 1, 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = ([0] + ends[:n - 1].tolist())
    last = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(first, last)), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for lo in range(0, n, VOTES):    # 64 bytes a shingle while they are counted
        bits = np.unpackbits(h[lo:lo + VOTES].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (signed) of every row, and h, a hash of its text."""
    def make():
        return lambda texts, h: [[fingerprint(t, shingle) for t in texts]]
    src = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    return project_columns(src, ["doc_id", "h"], ["text", "h"], [T.StructField("fp", T.LongType())], make)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code word in the reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Levels of nodes over Gray-sorted fingerprints, each with the bits its members share."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        low, high = fps, fps
        self.levels = []          # from the leaves up: (shared mask, pattern)
        size = LEAF
        while True:
            cut = np.arange(0, len(low), size)
            low, high = np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut)
            mask = ~(low ^ high)
            self.levels.append((mask, low & mask))
            if len(cut) == 1:
                break
            size = FANOUT

    def links(self, max_bits: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Spanning forest (i, j) of all pairs within ``max_bits``."""
        parent = np.arange(len(self.fps))

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i
        edges = []
        for q0 in range(0, len(self.fps), block):
            q = np.arange(q0, min(q0 + block, len(self.fps)))
            node = np.zeros(len(q), np.int64)
            above = np.zeros(len(q), np.uint64)
            diff = np.zeros(len(q), np.int64)
            for level in range(len(self.levels) - 1, -1, -1):
                mask, pattern = self.levels[level]
                diff = diff + np.bitwise_count((self.fps[q] ^ pattern[node]) & mask[node] & ~above)
                ok = diff <= max_bits
                q, node, diff, above = q[ok], node[ok], diff[ok], mask[node[ok]]
                width = FANOUT if level else LEAF
                count = len(self.levels[level - 1][0]) if level else len(self.fps)
                child = (node[:, None] * width + np.arange(width)).ravel()
                q, diff, above = np.repeat(q, width), np.repeat(diff, width), np.repeat(above, width)
                ok = child < count
                if not level:
                    ok &= child > q
                q, node, diff, above = q[ok], child[ok], diff[ok], above[ok]
            diff = diff + np.bitwise_count((self.fps[q] ^ self.fps[node]) & ~above)
            ok = diff <= max_bits
            for i, j in zip(q[ok].tolist(), node[ok].tolist()):
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    edges.append((i, j))
        pairs = np.array(edges, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]


def _blocks(fixed: int, parts: int) -> list[int]:
    """Masks that cut the free bits of ``fixed`` into ``parts`` runs of nearly equal size."""
    free = [1 << b for b in range(63, -1, -1) if not fixed >> b & 1]
    return [sum(free[len(free) * i // parts:len(free) * (i + 1) // parts]) for i in range(parts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _split(rows: DataFrame, max_bits: int) -> DataFrame:
    """Each (mask, fp) once per block of its free bits, with that block fixed too."""
    parts = max_bits + 1

    def run(batches):
        memo: dict[int, list[int]] = {}
        for b in batches:
            masks = b.column(0).to_numpy().astype(np.int64)
            fps = b.column(1).to_numpy().astype(np.int64)
            for m in np.unique(masks).tolist():
                if m not in memo:
                    memo[m] = [_signed((m & FULL) | x) for x in _blocks(m & FULL, parts)]
                mine = fps[masks == m]
                for wider in memo[m]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(mine), wider)), pa.array(mine)], names=["mask", "fp"])
    return map_arrow(rows.select("mask", "fp"), run, "mask long, fp long")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) whose components are all links'."""
    if max_group < 2 ** (max_bits + 1):
        raise ValueError("max_group must be at least 2 ** (max_bits + 1), so that a larger group has free bits")
    groups = _keyed(_split(fps.select(F.lit(0).cast("long").alias("mask"), "fp"), max_bits))
    parts, key = [], ["mask", "pattern"]
    while True:
        groups = materialize(groups, "simhash-groups")
        large = groups.groupBy(*key).count().filter(F.col("count") > max_group).select(*key)
        if not large.take(1):
            parts.append(groups)
            break
        large = materialize(large, "simhash-large")
        parts.append(groups.join(large, key, "left_anti"))
        groups = _keyed(_split(groups.join(large, key, "left_semi"), max_bits))
    found = [_search(p, max_bits) for p in parts]
    out = found[0]
    for p in found[1:]:
        out = out.union(p)
    return out.distinct()


def _search(groups: DataFrame, max_bits: int) -> DataFrame:
    """Run the index over each (mask, pattern) group; groups arrive whole and in order."""
    def run(batches):
        rest = None

        def solve(rows):
            mask, pattern, fp = rows
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
            bounds = np.concatenate([[0], new, [len(fp)]])
            a, b = [], []
            for lo, hi in zip(bounds[:-1][np.diff(bounds) > 1].tolist(), bounds[1:][np.diff(bounds) > 1].tolist()):
                x = fp[lo:hi].view(np.uint64)
                x = x[np.argsort(gray_rank(x), kind="stable")]
                if len(x) == 2:
                    i, j = ([0], [1]) if int(x[0] ^ x[1]).bit_count() <= max_bits else ([], [])
                else:
                    i, j = GrayIndex(x).links(max_bits)
                a.append(x[i])
                b.append(x[j])
            if a:
                a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
        for batch in batches:
            rows = [np.array(batch.column(i).to_numpy(), np.int64) for i in range(3)]
            if rest is not None:
                rows = [np.concatenate(x) for x in zip(rest, rows)]
            if not len(rows[0]):
                continue
            same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            rest = [x[cut:] for x in rows]
            if cut:
                yield from solve([x[:cut] for x in rows])
        if rest is not None:
            yield from solve(rest)
    ordered = groups.select("mask", "pattern", "fp").repartition("mask", "pattern")
    return map_arrow(ordered.sortWithinPartitions("mask", "pattern"), run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root): smallest node of each connected component, by alternating large and small stars."""
    edges = materialize(links.filter("a <> b").select("a", "b"), "cc")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above a node move to the smallest of the node and its neighbours
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(small_low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
                                                   .alias("a"), F.col("m").alias("b"))
                 .union(small_low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        stepped = materialize(small.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                              "cc")
        now, was = (x.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
                    for x in (stepped, edges))
        edges = stepped
        if now == was:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.groupBy("node").agg(F.min("root").alias("root"))


def grouped(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, h, fp, component_id for every row."""
    rows = materialize(fingerprints(docs, shingle), "simhash")
    per = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    per = materialize(per, "simhash-distinct")
    root = components(link_fingerprints(per, max_bits))
    per = per.join(root.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    ids = per.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per = materialize(per.join(ids, "root").select("fp", "root", "component_id"), "simhash-components")
    return rows.join(per, "fp").select("doc_id", "h", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return grouped(docs, shingle, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@guarded("doc_id", "text")
def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group, with its own columns: the one of the smallest (doc_id, text hash)."""
    rows = grouped(docs, shingle, max_bits)
    pick = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h")
    best = materialize(rows.groupBy("root").agg(F.min(pick).alias("k")).select(
        F.col("k.doc_id").alias("_k_id"), F.col("k.h").alias("_k_h")), "simhash-kept")
    cand = docs.withColumn("_k_text", F.xxhash64("text"))
    kept = cand.join(best, cand["doc_id"].eqNullSafe(best["_k_id"]) & (cand["_k_text"] == best["_k_h"]), "left_semi")
    plain = [c for c, t in docs.dtypes if t.partition("(")[0] in
             ("string", "bigint", "int", "double", "float", "boolean", "decimal", "date", "timestamp", "binary")]
    order = W.partitionBy("doc_id", "_k_text").orderBy(*[F.col(f"`{c}`") for c in plain])
    return kept.withColumn("_k_row", F.row_number().over(order)).filter("_k_row = 1").select(
        *[f"`{c}`" for c in docs.columns])
