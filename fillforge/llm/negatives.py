"""Hard negatives by exact search in Hilbert-ordered blocks of vectors with zone maps."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillforge.llm.common import ship, staged, unstage
from fillforge.llm.minhash import each_block

BLOCK = 512  # vectors of a block
SLICE_BYTES = 1 << 26  # of the vectors of a slice, which one task holds at a time
TASKS, LEAST = 4, 4096  # so many slices per core are made, of so many vectors at least
BITS = 4  # bits of a dimension in the Hilbert order
VISITORS = 1024  # anchors that are compared with a slice at a time
ZONES = 512  # zones that are compared with VISITORS anchors at a time

FLOOR, CEILING = -(2**63 - 1), 2**63 - 1
ROW = "row long, id long, label long, d int, v binary"


def matrix(column, d: int) -> np.ndarray:
    """Whole components of packed rows of d, as doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, d)


def ints(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, object)
    out[:] = [[int(c) for c in r] for r in x]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows with whole components. Doubles hold them up to 2^53; beyond that Python's integers
    are used, and what exceeds 64 bits counts as the largest or smallest value."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    if a.shape[1] * np.abs(a).max() * np.abs(b).max() < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return np.clip(ints(a) @ ints(b).T, FLOOR, CEILING).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each row of a with any vector between low and high, by interval arithmetic."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    wide = lambda x, y: np.concatenate([x, y], axis=1)
    return products(wide(up, down), wide(low, high)), products(wide(up, down), wide(high, low))


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid points along the Hilbert curve, as rows of bits from the highest.

    x: whole numbers below 2^bits, one row per point. Coordinates are turned into their transpose from the highest bit
    down (each set bit flips the lower bits of the first coordinate, each clear one swaps them), then Gray-coded.
    """
    x = x.astype(np.uint32).T.copy()
    for shift in range(bits - 1, 0, -1):
        q = np.uint32(1 << shift)
        low = q - np.uint32(1)
        for i in range(len(x)):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(set_, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    for shift in range(bits - 1, 0, -1):
        q = np.uint32(1 << shift)
        flip ^= np.where((x[-1] & q) != 0, q - np.uint32(1), 0).astype(np.uint32)
    x ^= flip
    return np.concatenate([(x >> np.uint32(s) & np.uint32(1)).T for s in range(bits - 1, -1, -1)], axis=1).astype(np.uint8)


def placed(largest: float):
    """(row, id, label, d, v as list) to rows with packed vectors and their place on the curve."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                lists, sizes = part.column("v"), part.column("d").to_numpy()
                keys, packed = [None] * part.num_rows, [None] * part.num_rows
                for d in np.unique(sizes).tolist():
                    at = np.flatnonzero(sizes == d)
                    x = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)
                    grid = np.minimum(np.floor((x / largest + 1) * (1 << BITS - 1)), (1 << BITS) - 1) if largest else np.zeros_like(x)
                    for i, key, row in zip(at.tolist(), np.packbits(hilbert(grid, BITS), axis=1), x, strict=True):
                        keys[i], packed[i] = key.tobytes(), row.astype("<f8").tobytes()
                cols = [part.column(c) for c in ("row", "id", "label", "d")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(packed, pa.binary()), pa.array(keys, pa.binary())], ["row", "id", "label", "d", "v", "place"])

    return run


BLOCKS = "s int, b int, d int, label long, n int, rows array<long>, ids array<long>, v binary, low array<double>, high array<double>"
NAMES = [c.split()[0] for c in BLOCKS.split(", ")]


def packed_blocks(batches):
    """The rows of a range partition, sorted by d, label and place, to blocks of one label each, with the least and largest
    value of each dimension; after them one row per d and label without vectors (b is null): the zone of all its blocks."""
    s, no, zones, held = TaskContext.get().partitionId(), 0, {}, None

    def block(t: pa.Table):
        nonlocal no
        d, label = t.column("d")[0].as_py(), t.column("label")[0].as_py()
        x = matrix(t.column("v"), d)
        low, high = x.min(axis=0), x.max(axis=0)
        if (d, label) in zones:
            n, was_low, was_high = zones[d, label]
            zones[d, label] = n + len(x), np.minimum(low, was_low), np.maximum(high, was_high)
        else:
            zones[d, label] = len(x), low, high
        no += 1
        return [s, no - 1, d, label, len(x), t.column("row").to_pylist(), t.column("id").to_pylist(), x.tobytes(), low, high]

    def batch_of(rows: list):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SCHEMA)], schema=SCHEMA)

    for batch in batches:
        held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        while held.num_rows:
            keys = np.stack([held.column(c).to_numpy() for c in ("d", "label")])
            same = int(np.argmax(np.append((keys != keys[:, :1]).any(axis=0), True)))
            if same == held.num_rows and same < BLOCK:
                break  # more of this label may come
            yield batch_of([block(held.slice(0, min(same, BLOCK)))])
            held = held.slice(min(same, BLOCK))
    if held is not None and held.num_rows:
        yield batch_of([block(held)])
    if zones:
        yield batch_of([[s, None, d, label, n, None, None, None, low, high] for (d, label), (n, low, high) in zones.items()])


SCHEMA = pa.schema([("s", pa.int32()), ("b", pa.int32()), ("d", pa.int32()), ("label", pa.int64()), ("n", pa.int32()), ("rows", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("v", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])


def may_hold(least, largest, low, high) -> np.ndarray:
    """Which pairs of anchors (rows) and boxes (columns) can have a score inside any of the anchor's windows."""
    out = np.zeros(least.shape, bool)
    for w in range(low.shape[1]):
        out |= (largest >= low[:, w : w + 1]) & (least <= high[:, w : w + 1])
    return out


def windows_of(t, names=("low", "high")) -> list[np.ndarray]:
    """The windows of anchors as arrays, one row each; missing ones are empty (low > high)."""
    out = []
    for name, fill in zip(names, (CEILING, FLOOR), strict=True):
        rows = t.column(name).to_pylist()
        x = np.full((len(rows), max(1, max(map(len, rows), default=1))), fill, np.int64)
        for i, r in enumerate(rows):
            x[i, : len(r)] = r
        out.append(x)
    return out


def choose(same: bool):
    """Blocks of anchors and zones of one length to the pairs (s, row) of which the slice must be read for the anchor."""

    def run(batches):
        for t in each_block(batches):
            is_zone = t.column("zone").to_numpy()
            d = int(t.column("g")[0].as_py())
            a, z = t.filter(pa.array(~is_zone)), t.filter(pa.array(is_zone))
            if not a.num_rows or not z.num_rows:
                continue
            lo, hi = (z.column(c).combine_chunks().flatten().to_numpy().reshape(-1, d) for c in ("zone_low", "zone_high"))
            for at in range(0, a.num_rows, VISITORS):
                some = a.slice(at, VISITORS)
                need = may_hold(*bounds(matrix(some.column("v"), d), lo, hi), *windows_of(some))
                need &= (some.column("label").to_numpy()[:, None] == z.column("label").to_numpy()[None]) == same
                i, j = np.nonzero(need)
                pairs = np.unique(np.stack([z.column("s").to_numpy()[j], some.column("row").to_numpy()[i]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int32()), pa.array(pairs[1], pa.int64())], ["s", "row"])

    return run


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group: by score from the highest, then by id."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    start = np.append(True, g[1:] != g[:-1]) if len(g) else np.zeros(0, bool)
    rank = np.arange(len(g)) - np.maximum.accumulate(np.where(start, np.arange(len(g)), 0))
    return order[rank < k]


def search_slice(same: bool, k: int):
    """Slices (their blocks first, then the anchors that visit them) to the first k of each anchor's windows in the slice.

    Blocks are read in the order of their largest possible score; a block is left out for an anchor if its bounds miss all
    windows, or if each window holds k already that are above what the block can reach.
    """

    def visit(blocks: list, d: int, anchors: pa.Table):
        a, label, own = matrix(anchors.column("v"), d), anchors.column("label").to_numpy(), anchors.column("row").to_numpy()
        low, high = windows_of(anchors)
        w = low.shape[1]
        least, largest = bounds(a, np.stack([b["low"] for b in blocks]), np.stack([b["high"] for b in blocks]))
        of = np.array([b["label"] for b in blocks])
        group, score, ids = (np.empty(0, np.int64) for _ in range(3))
        for j in np.argsort(-largest.max(axis=0), kind="stable").tolist():
            b = blocks[j]
            need = may_hold(least[:, j : j + 1], largest[:, j : j + 1], low, high)[:, 0] & ((label == of[j]) == same)
            at = np.flatnonzero(need)
            if not len(at):
                continue
            got = products(a[at], b["v"])
            new = []
            for i in range(w):
                hit = (got >= low[at, i : i + 1]) & (got <= high[at, i : i + 1])
                hit &= own[at][:, None] != b["rows"][None]
                x, y = np.nonzero(hit)
                new.append((at[x] * w + i, got[x, y], b["ids"][y]))
            group, score, ids = (np.concatenate([old, *[n[c] for n in new]]) for c, old in enumerate((group, score, ids)))
            keep = best(group, score, ids, k)
            group, score, ids = group[keep], score[keep], ids[keep]
            full = np.flatnonzero(np.bincount(group, minlength=len(a) * w) == k)  # groups are sorted, so their k-th is the last
            ends = np.searchsorted(group, full, side="right") - 1
            flat = low.reshape(-1)
            flat[full] = np.maximum(flat[full], score[ends])
        return own[group // w], group % w, score, ids

    def run(batches):
        s, blocks, waiting = None, [], []

        def flush():
            if waiting and blocks:
                t = pa.Table.from_batches(waiting)
                sizes = t.column("d").to_numpy()
                for d in np.unique(sizes).tolist():
                    row, w, score, ids = visit([b for b in blocks if b["d"] == d], d, t.filter(pa.array(sizes == d)))
                    missing = pa.array(ids, mask=ids == CEILING)
                    yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(w.astype(np.int32)), pa.array(score), missing], ["row", "w", "score", "id"])
            waiting.clear()

        for batch in batches:
            keys = batch.column("s").to_numpy()
            anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]) | (anchor[1:] != anchor[:-1])) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if keys[lo] != s:
                    yield from flush()
                    s, blocks = keys[lo], []
                if anchor[lo]:
                    for at in range(lo, hi, VISITORS):
                        waiting.append(batch.slice(at, min(VISITORS, hi - at)))
                        if sum(x.num_rows for x in waiting) >= VISITORS:
                            yield from flush()
                else:
                    for r in batch.slice(lo, hi - lo).to_pylist():
                        ids = np.array([CEILING if i is None else i for i in r["ids"]], np.int64)
                        blocks.append({"d": r["d"], "label": r["label"], "rows": np.array(r["rows"], np.int64), "ids": ids, "v": np.frombuffer(r["v"], "<f8").reshape(-1, r["d"]), "low": np.array(r["zone_low"]), "high": np.array(r["zone_high"])})
        yield from flush()

    return run


def first_in_windows(blocks: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """The first k rows inside each window of each anchor, among the rows of its label (same) or of all others.

    anchors: row, label, d, v, low and high (arrays: the windows). Returns row, w (the window's number), score, id, rank.
    1. Anchors and zones meet in blocks by length; interval bounds choose the slices that an anchor must read.
    2. A slice's blocks and its anchors meet in one task, which holds the blocks of one slice and one batch of anchors.
    3. The slices' lists are merged.
    """
    spark = blocks.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    zones = blocks.where("b is null").select(F.col("d").alias("g"), "s", "label", F.col("low").alias("zone_low"), F.col("high").alias("zone_high"))
    visitors = anchors.select(F.col("d").alias("g"), "row", "label", "v", "low", "high")
    parts = lambda df, size, name: df.groupBy("g").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    sizes = parts(visitors, 8 * VISITORS, "ms").join(parts(zones, ZONES, "ps"), "g")
    own = lambda key, n: F.pmod(F.xxhash64(*key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = visitors.join(sizes, "g").withColumn("m", own(["row"], "ms")).withColumn("p", every("ps")).withColumn("zone", F.lit(False))
    dealt = dealt.unionByName(zones.join(sizes, "g").withColumn("m", every("ms")).withColumn("p", own(["s", "label"], "ps")).withColumn("zone", F.lit(True)), allowMissingColumns=True)
    dealt = dealt.repartition(tasks, "g", "m", "p").sortWithinPartitions("g", "m", "p")
    chosen = staged(dealt.mapInArrow(choose(same), "s int, row long").distinct(), "chosen")
    sent = chosen.join(anchors, "row").withColumn("anchor", F.lit(True))
    read = blocks.where("b is not null").join(chosen.select("s").distinct(), "s", "left_semi")
    held = read.select("s", "d", "label", "rows", "ids", "v", F.col("low").alias("zone_low"), F.col("high").alias("zone_high")).withColumn("anchor", F.lit(False))
    both = held.unionByName(sent.select("s", "d", "label", "row", "v", "low", "high", "anchor"), allowMissingColumns=True)
    found = both.repartition(tasks, "s").sortWithinPartitions("s", "anchor").mapInArrow(search_slice(same, k), "row long, w int, score long, id long")
    order = W.partitionBy("row", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Callable[[Column], Column], id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """Hard negatives of each anchor and each of its positives, exactly.

    Components count as floor(scale * x); a row's score is its inner product with the anchor. Higher scores come first,
    ties by smaller id, null ids last. Positives are an anchor's first other rows of its label; negatives are the first
    rows of other labels whose score lies between least and most percent of the positive's. anchor turns
    the id column into the condition that a row is an anchor. Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null label or vector, or with null or non-finite components (also once scaled), take no part; nor do
    empty vectors. Vectors of other lengths than the anchor's score with nothing. Rows that repeat an id are rows of their
    own, as anchors too; a row without id can be chosen but is no anchor. A positive with a score below zero has an empty
    window. An empty table gives an empty result. Other columns are not read, so their names cannot clash.

    Rows are laid out once as Parquet in the order of length, label and Hilbert curve, in slices (range partitions) of
    blocks, with the least and largest value of each dimension per block and per slice and label.
    """
    spark = vectors.sparkSession
    ship(spark)
    whole = lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.transform(F.col(vector_col).cast("array<double>"), lambda x: whole(x * scale)).alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("label").isNotNull() & F.coalesce(finite & (F.size("v") > 0), F.lit(False)))
    rows = staged(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", F.size("v").alias("d"), "v"), "vectors")
    seen = rows.agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest"), F.max("d").alias("d")).first()
    size = max(LEAST, -(-seen["n"] // (TASKS * spark.sparkContext.defaultParallelism)))
    size = max(BLOCK, min(size, SLICE_BYTES // (8 * (seen["d"] or 1))))
    place = placed(seen["largest"] or 0.0)
    on_curve = rows.mapInArrow(place, f"{ROW}, place binary")
    dealt = on_curve.repartitionByRange(max(1, -(-seen["n"] // size)), "d", "label", "place", "row").sortWithinPartitions("d", "label", "place", "row")
    blocks = staged(dealt.select("row", "id", "label", "d", "v").mapInArrow(packed_blocks, BLOCKS), "blocks")
    anchors = staged(rows.where(anchor(F.col("id"))).mapInArrow(place, f"{ROW}, place binary").drop("place"), "anchors")
    unstage(rows)
    anywhere = anchors.withColumn("low", F.array(F.lit(FLOOR))).withColumn("high", F.array(F.lit(CEILING)))
    near = staged(first_in_windows(blocks, anywhere.drop("id"), True, positives), "positives")
    percent = lambda p, up: (F.ceil if up else F.floor)(F.col("score").cast("decimal(20,0)") * p / 100).cast("long")
    with_windows = near.select("row", F.struct((F.col("rank") - 1).alias("w"), "id", "score", percent(least, True).alias("low"), percent(most, False).alias("high")).alias("x"))
    with_windows = with_windows.groupBy("row").agg(F.array_sort(F.collect_list("x")).alias("xs")).join(anchors.select("row", "label", "d", "v"), "row")
    windows = with_windows.select("row", "label", "d", "v", F.col("xs.low").alias("low"), F.col("xs.high").alias("high"))
    far = first_in_windows(blocks, windows, False, negatives).select("row", "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = near.select("row", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return named.join(far, ["row", "w"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
