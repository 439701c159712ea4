"""Hard-negative mining by threshold joins over an inverted index (operator 13).

An anchor's positives are its best-scoring rows of its own label; a positive's hard negatives are the
best rows of other labels whose score lies in a window below the positive's. Scores are integer
inner products.

Both searches are threshold joins in the manner of L2AP. Dimensions are ordered by energy and cut
into groups. Of a row, the inverted index leaves out the groups from c on where the norm of the
row's rest times the largest norm of an anchor's rest is below the threshold: a pair must earn the
threshold's remainder in the groups before. Partial scores are accumulated group by group over the
postings; a pair goes once its partial score plus the product of both remaining norms is below the
anchor's threshold, and what is left is finished exactly. A threshold starts where a window is
expected to fill and is lowered until every window of the anchor has what it needs or its lower end is reached.

Scale. Rows are dealt into blocks at random (a number given once and written), so neither a label
nor copies of a vector can fill one; every anchor visits every block. A task holds the rows of one
block and lets the anchors stream past it. What the first blocks find is a lower bound on what an
anchor needs, and raises the lower end of its windows for all other blocks, which then
report next to nothing. No anchor or row passes through the driver.

Defined results: rows with a null label, a null vector or a null or non-finite component take no
part. A row with a null id is no anchor, is not relabelled and comes last among equal scores. Rows
with an anchor's own id are not its positives or negatives; equal anchors are mined once; other
repeated rows count each. Components that a shorter vector lacks are 0. An anchor without positives
or a positive without negatives gives no row; an empty table gives an empty result; other columns
are ignored. A score beyond 64 bits is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyrisk.llm.common import map_arrow, materialize

POSITIVES, NEGATIVES = 5, 3
QUERY_STEP = 50           # anchors are the rows whose id this divides
SCALE = 256.0
BLOCK_ROWS = 32_768       # rows that a task holds at once
SAMPLE_BLOCKS = 16        # one block in so many is searched first, for the bounds
CELLS = 4_000_000         # pairs accumulated at once
GROUP = 8                 # dimensions of a posting group
SPARSE = 0.05             # share of live pairs below which they are finished one by one
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
_HIT = "aid long, w int, id long, score long"


def integer_rows(embeddings: DataFrame) -> DataFrame:
    """id, label, v (integer components), deal (a random number), of every row that takes part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return rows.select(F.col("vec_id").cast("long").alias("id"), moved.alias("label"),
                       F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double"))).alias("v"),
                       F.abs(F.xxhash64(F.monotonically_increasing_id()) % (1 << 30)).alias("deal"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows, the shorter ones filled with zeros."""
    size = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if len(size) and (size == size[0]).all():
        return values.reshape(len(size), size[0])
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = values
    return out


def _wide(x: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, dims - x.shape[1])))


def _rest_norms(x: np.ndarray) -> np.ndarray:
    """Per row the norms of its dimensions from group 0, 1, ... on (0 after the last)."""
    cut = np.arange(0, x.shape[1], GROUP)
    squares = np.add.reduceat(x.astype(np.float64) ** 2, cut, axis=1) if len(cut) else np.zeros((len(x), 0))
    rest = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.pad(np.sqrt(rest), ((0, 0), (0, 1))) * (1 + 1e-9)


class Block:
    """The rows a task holds, in the order of their ids (null last)."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, missing))
        self.ids, self.missing, self.labels = ids[order], missing[order], labels[order]
        v = vectors[order]
        self.dims = np.argsort(-(v.astype(np.float64) ** 2).sum(0), kind="stable")
        self.vectors = v[:, self.dims]
        self.rest = _rest_norms(self.vectors)

    def of(self, rows: np.ndarray) -> Block:
        """The block with some of its rows."""
        part = object.__new__(Block)
        part.dims = self.dims
        part.ids, part.missing, part.labels = self.ids[rows], self.missing[rows], self.labels[rows]
        part.vectors, part.rest = self.vectors[rows], self.rest[rows]
        return part


def _exact_kind(a: np.ndarray, b: np.ndarray):
    """The type in which all inner products are exact."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top >= 2.0 ** 63:
        raise OverflowError("a score may exceed 64 bits")
    return np.float64 if top < 2.0 ** 53 else np.int64


def threshold_join(block: Block, anchors: np.ndarray, rest: np.ndarray, least: np.ndarray):
    """(anchor, row, score) of all pairs whose score is at least the anchor's threshold."""
    kind = _exact_kind(anchors, block.vectors)
    groups = block.rest.shape[1] - 1
    # Groups of each row that the index holds: those before its rest is covered.
    covered = block.rest * rest.max(axis=0) < least.min()
    indexed = np.where(covered.any(axis=1), covered.argmax(axis=1), groups)
    order = np.argsort(-indexed, kind="stable")
    rows, held = block.vectors[order].astype(kind), indexed[order]
    posted = np.searchsorted(-held, -np.arange(groups), side="left")    # rows in the postings of group c
    a = anchors.astype(kind)
    score = np.zeros((len(a), len(rows)), kind)
    done = np.zeros(len(rows), np.int64)    # groups accumulated per row
    for c in range(groups):
        n, cut = posted[c], slice(c * GROUP, (c + 1) * GROUP)
        if not n:
            break
        score[:, :n] += a[:, cut] @ rows[:n, cut].T
        done[:n] = c + 1
        if c >= groups // 2 and c + 1 < groups:
            bound = score + rest[:, done] * block.rest[order, done]
            if (bound >= least[:, None]).mean() < SPARSE:
                break
    bound = score + rest[:, done] * block.rest[order, done]
    at, row = np.nonzero(bound >= least[:, None])
    out = score[at, row]
    for c in range(int(done.min(initial=groups)), groups):    # finish what is left, pruning on the way
        open_ = done[row] <= c
        if not open_.any():
            continue
        cut = slice(c * GROUP, (c + 1) * GROUP)
        todo = np.flatnonzero(open_)
        for lo in range(0, len(todo), 1 << 18):
            i = todo[lo:lo + (1 << 18)]
            out[i] += np.einsum("ij,ij->i", a[at[i], cut], rows[row[i], cut])
        reach = np.maximum(c + 1, done[row])
        live = out + rest[at, reach] * block.rest[order[row], reach] >= least[at]
        at, row, out = at[live], row[live], out[live]
    return at, order[row], out.astype(np.int64)


def _best(at, row, score, low, high, need):
    """Of each anchor's pairs inside [low, high] the ``need`` best, ties by row order; and their number."""
    inside = np.flatnonzero((score >= low[at]) & (score <= high[at]))
    a, s, r = at[inside], score[inside], row[inside]
    order = np.lexsort((r, -s, a))
    a, s, r = a[order], s[order], r[order]
    first = np.searchsorted(a, a, side="left")
    keep = np.arange(len(a)) - first < need
    return a[keep], r[keep], s[keep], np.bincount(a, minlength=len(low))


def fill_windows(block: Block, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray,
                 high: np.ndarray, need: int, same: bool):
    """(anchor, window, row, score): the best ``need`` rows of each window [low, high] (anchors x
    windows; an empty window has low > high) among the rows of the same label, or of other labels."""
    rest = _rest_norms(vectors)
    sample = block.vectors[::max(1, len(block.ids) // 256)].astype(np.float64)
    guess = vectors.astype(np.float64) @ sample.T
    mean, spread = guess.mean(axis=1), guess.std(axis=1) + 1
    used = low <= high
    floor = np.where(used, low, HIGHEST).min(axis=1).astype(np.float64)
    top = np.where(used, high, HIGHEST).min(axis=1).astype(np.float64)
    start = np.sqrt(2 * np.log(max(len(block.ids) / (2.0 * need), 2.0)))
    level = np.minimum(mean + start * spread, top - spread / 4)
    active = np.flatnonzero(used.any(axis=1))
    found = []
    while len(active):
        # Below its mean half of the block is above it: take the windows to their end.
        least = np.maximum(np.where(level[active] < mean[active], -np.inf, level[active]), floor[active])
        at, row, score = threshold_join(block, vectors[active], rest[active], least)
        fits = (block.labels[row] == labels[active][at]) == same
        fits &= block.missing[row] | (block.ids[row] != ids[active][at])
        at, row, score = at[fits], row[fits], score[fits]
        full = np.ones(len(active), bool)
        picked = []
        for w in range(low.shape[1]):
            lo, hi = low[active, w], high[active, w]
            a, r, s, n = _best(at, row, score, lo, hi, need)
            picked.append((a, w, r, s))
            full &= (n >= need) | (lo >= least) | (lo > hi)
        full |= np.isneginf(least)
        for a, w, r, s in picked:
            ok = full[a]
            found.append((active[a[ok]], np.full(int(ok.sum()), w), r[ok], s[ok]))
        active = active[~full]
        level[active] -= 0.75 * spread[active]
    if not found:
        return [np.zeros(0, np.int64)] * 4
    return [np.concatenate(x) for x in zip(*found)]


def _sweep(need: int, same: bool):
    def search(block: Block, batch: pa.RecordBatch):
        ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
        v = _matrix(batch.column("v"))
        dims = max(v.shape[1], block.vectors.shape[1])
        if dims > block.vectors.shape[1]:
            block = Block(block.ids, block.missing, block.labels,
                          _wide(block.vectors[:, np.argsort(block.dims)], dims))
        v = _wide(v, dims)[:, block.dims]
        windows = batch.column("windows")
        size = np.diff(windows.offsets.to_numpy())
        flat = windows.flatten()
        wide = int(size.max(initial=0))
        low, high = np.ones((len(ids), wide), np.int64), np.zeros((len(ids), wide), np.int64)
        slot = np.arange(wide) < size[:, None]
        low[slot], high[slot] = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
        number = np.zeros((len(ids), wide), np.int32)
        number[slot] = flat.field("w").to_numpy()
        if same:    # only the rows of an anchor's label can be its positives
            parts = [(np.flatnonzero(labels == x), block.of(np.flatnonzero(block.labels == x)))
                     for x in np.unique(labels)]
        else:
            parts = [(np.arange(len(ids)), block)]
        aid = batch.column("aid").to_numpy()
        for anchors, part in parts:
            if not len(part.ids) or not wide:
                continue
            step = max(1, CELLS // len(part.ids))
            for lo in range(0, len(anchors), step):
                i = anchors[lo:lo + step]
                a, w, r, s = fill_windows(part, ids[i], labels[i], v[i], low[i], high[i], need, same)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(aid[i[a]]), pa.array(number[i[a], w]), pa.array(part.ids[r], mask=part.missing[r]),
                     pa.array(s)], names=["aid", "w", "id", "score"])

    def run(batches):
        now, held, block = None, [], None
        for b in batches:
            numbers, tags = b.column("block").to_numpy(), b.column("tag").to_numpy()
            cuts = np.flatnonzero(np.diff(numbers.astype(np.int64) * 2 + tags)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(numbers)]):
                part = b.slice(int(lo), int(hi - lo))
                if numbers[lo] != now:
                    now, held, block = numbers[lo], [], None
                if tags[lo] == 0:
                    held.append(part)
                    continue
                if block is None and held:
                    vectors = [_matrix(x.column("v")) for x in held]
                    dims = max(x.shape[1] for x in vectors)
                    ids = [x.column("id") for x in held]
                    block = Block(np.concatenate([x.fill_null(0).to_numpy() for x in ids]),
                                  np.concatenate([x.is_null().to_numpy(zero_copy_only=False) for x in ids]),
                                  np.concatenate([x.column("label").to_numpy() for x in held]),
                                  np.concatenate([_wide(x, dims) for x in vectors]))
                    held = []
                if block is not None:
                    yield from search(block, part)
    return run


def best_in_windows(rows: DataFrame, anchors: DataFrame, need: int, same: bool, blocks: int,
                    first: int, last: int) -> DataFrame:
    """aid, w, id, score: the best ``need`` of every window over the blocks first .. last - 1.
    ``anchors``: aid, id, label, v, windows (array of {w, lo, hi})."""
    spark = rows.sparkSession
    number = (F.col("deal") % blocks).cast("int")
    none = F.lit(None)
    kind = "array<struct<w:int,lo:bigint,hi:bigint>>"
    held = rows.withColumn("block", number).filter((F.col("block") >= first) & (F.col("block") < last)).select(
        "block", F.lit(0).alias("tag"), none.cast("long").alias("aid"), "id", "label", "v", none.cast(kind).alias("windows"))
    visits = anchors.select(F.explode(F.sequence(F.lit(first), F.lit(last - 1))).alias("block"), F.lit(1).alias("tag"),
                            "aid", "id", "label", "v", F.col("windows").cast(kind).alias("windows"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), last - first)
    dealt = held.unionByName(visits).repartition(parts, "block").sortWithinPartitions("block", "tag")
    return best_hits(map_arrow(dealt, _sweep(need, same), _HIT), need)


def best_hits(hits: DataFrame, need: int) -> DataFrame:
    order = W.partitionBy("aid", "w").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= need)


def search_all(rows: DataFrame, anchors: DataFrame, need: int, same: bool, blocks: int, name: str) -> DataFrame:
    """``best_in_windows`` over all blocks: a few first, whose finds raise the windows' lower ends."""
    some = -(-blocks // SAMPLE_BLOCKS) if blocks > 1 else 1
    found = materialize(best_in_windows(rows, anchors, need, same, blocks, 0, some), f"{name}-first")
    if some < blocks:
        bounds = found.filter(F.col("rank") == need).groupBy("aid").agg(
            F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("bound"))    # a row per window at most
        raised = F.transform("windows", lambda x: F.struct(
            x["w"].alias("w"), F.greatest(x["lo"], F.coalesce(F.try_element_at("bound", x["w"]), x["lo"])).alias("lo"),
            x["hi"].alias("hi")))
        rest = anchors.join(bounds, "aid", "left").withColumn("windows", raised).drop("bound")
        more = best_in_windows(rows, rest, need, same, blocks, some, blocks)
        both = found.drop("rank").unionByName(more.drop("rank"))
        found = materialize(best_hits(both, need), f"{name}-all")
    return found


def mine(embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, query_step: int = QUERY_STEP,
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = embeddings.sparkSession
    rows = materialize(integer_rows(embeddings), "mine-rows")
    n = rows.count()
    # Blocks of block_rows, or smaller ones while there are fewer blocks than partitions.
    blocks = max(-(-n // block_rows), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // 512)), 1)
    anchors = rows.filter(F.col("id") % query_step == 0).select("id", "label", "v").distinct()
    anchors = materialize(anchors.withColumn("aid", F.monotonically_increasing_id()), "mine-anchors")
    every = F.array(F.struct(F.lit(0).alias("w"), F.lit(LOWEST).alias("lo"), F.lit(HIGHEST).alias("hi")))
    near = search_all(rows, anchors.withColumn("windows", every), positives, True, blocks, "mine-positives")
    near = near.select("aid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                       F.col("rank").alias("positive_rank"))
    # Half to 95 hundredths of the positive's score; equal scores share a window (w: the first of them).
    ps = F.col("positive_score")
    low = F.expr("positive_score div 2 + positive_score % 2")
    high = F.expr("(positive_score div 100) * 95 + (positive_score % 100) * 95 div 100")
    spans = near.filter(ps >= 0).groupBy("aid", "positive_score").agg(F.min("positive_rank").alias("w"))
    spans = spans.groupBy("aid").agg(F.collect_list(F.struct(
        F.col("w").cast("int").alias("w"), low.alias("lo"), high.alias("hi"))).alias("windows"))
    far = search_all(rows, anchors.join(spans, "aid"), negatives, False, blocks, "mine-negatives")
    far = far.select("aid", "w", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    shared = W.partitionBy("aid", "positive_score")
    near = near.withColumn("w", F.min("positive_rank").over(shared))
    names = anchors.select("aid", F.col("id").alias("anchor_id"))
    return near.join(far, ["aid", "w"]).join(names, "aid").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
