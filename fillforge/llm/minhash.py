"""Near duplicates by SuperMinHash signatures, banding, verification on full sets and component grouping."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillforge.llm.common import components, ship, staged, unwrapped, wrapped

ROWS, BANDS = 6, 32
SLOTS = ROWS * BANDS
BLOCK = 16384  # elements that are ranked together
FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser on unsigned arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the width-word shingles; a shorter word list is one shingle, no words none."""
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    take = min(width, len(h))
    n = len(h) - take + 1
    out = np.full(n, take, np.uint64)
    for j in range(take):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
    return np.unique(out)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash signatures, one row of SLOTS ranks per set.

    Every element walks its own random permutation of the slots; at step j it offers the rank j + u to its j-th slot.
    A slot keeps the least rank. All offers of step j lie below j + 1, so once each slot of a set holds a rank the set
    is done: later steps can't lower it. Elements of many sets take a step together.
    """
    parts = [(i, s[at : at + BLOCK]) for i, s in enumerate(sets) for at in range(0, len(s), BLOCK)]
    out = np.full((len(sets), SLOTS), FREE, np.uint64)
    at = 0
    while at < len(parts):
        end, total = at, 0
        while end < len(parts) and (end == at or total + len(parts[end][1]) <= BLOCK):
            total += len(parts[end][1])
            end += 1
        group = parts[at:end]
        ranks = ranked([s for _, s in group])
        for (i, _), row in zip(group, ranks, strict=True):
            np.minimum(out[i], row, out=out[i])
        at = end
    return out


def ranked(group: list[np.ndarray]) -> np.ndarray:
    owner = np.repeat(np.arange(len(group)), [len(s) for s in group])
    seed = np.concatenate(group)
    walk = np.broadcast_to(np.arange(SLOTS, dtype=np.uint8), (len(seed), SLOTS)).copy()
    row = np.arange(len(seed))
    best = np.full(len(group) * SLOTS, FREE, np.uint64)
    for j in range(SLOTS):
        draw = mixed(seed + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        k = j + (((draw >> np.uint64(32)) * np.uint64(SLOTS - j)) >> np.uint64(32)).astype(np.int64)
        slot = walk[row, k]
        walk[row, k] = walk[row, j]
        np.minimum.at(best, owner * SLOTS + slot, np.uint64(j << 32) | (draw & np.uint64(0xFFFFFFFF)))
        open_sets = (best.reshape(-1, SLOTS) == FREE).any(axis=1)
        if not open_sets.any():
            break
        more = open_sets[owner]
        if not more.all():
            owner, seed, row = owner[more], seed[more], row[more]
    return best.reshape(-1, SLOTS)


SKETCH = "id long, t long, n_shingles long, d1 long, d2 long, bands array<long>, sig binary"


def sketches(width: int):
    """Batches of (id, text hash, text as bytes) to sketches: set size, 128-bit digest of the set, band keys, one byte
    per slot."""

    def run(batches):
        for batch in batches:
            ids, hashes, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            for lo in range(0, len(texts), 256):
                sets = [shingles(t, width) for t in texts[lo : lo + 256]]
                full = [s for s in sets if len(s)]
                ranks = signatures(full) if full else np.empty((0, SLOTS), np.uint64)
                keys = np.zeros((len(full), BANDS), np.uint64)
                for b in range(BANDS):
                    key = np.full(len(full), b + 1, np.uint64)
                    for c in range(b * ROWS, b * ROWS + ROWS):
                        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + ranks[:, c])
                    keys[:, b] = key
                small = (mixed(ranks) & np.uint64(0xFF)).astype(np.uint8)
                digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                bands, sigs, i = [], [], 0
                for s in sets:
                    bands.append(keys[i].view(np.int64) if len(s) else None)
                    sigs.append(small[i].tobytes() if len(s) else None)
                    i += bool(len(s))
                half = lambda a: [int.from_bytes(d[a : a + 8], "little", signed=True) if d else None for d in digest]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, 256), hashes.slice(lo, 256), pa.array([len(s) for s in sets], pa.int64()), pa.array(half(0), pa.int64()), pa.array(half(8), pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                    ["id", "t", "n_shingles", "d1", "d2", "bands", "sig"],
                )

    return run


def full_sets(width: int):
    """Batches of texts as bytes to (class key, whole set)."""

    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo in range(0, len(texts), 256):
                sets = [s for t in texts[lo : lo + 256] if len(s := shingles(t, width))]
                keys = [int.from_bytes(xxhash.xxh3_128_digest(s.tobytes())[:8], "little", signed=True) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["k", "hashes"])

    return run


def near_agreement(floor: float):
    """Keeps the pairs whose signatures agree in at least floor of the slots."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SLOTS) for c in ("sig_a", "sig_b"))
            keep = (x == y).mean(axis=1) >= floor
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Groups of texts whose sets of width-word shingles are alike: 100 * intersection >= percent * union.

    Returns one row per row of docs: the id column, n_shingles, component_id (smallest id reachable by links, the own
    one included) and kept (id = component_id). Words are runs of non-blank characters, A-Z count as a-z. A text with
    fewer words than width is one shingle; null, empty and blank texts have none, link with nothing and have
    component_id = id. Several rows of one id are judged text by text. A row without id takes part in its group but
    names none; it is kept only if no row of its group has an id. Very long texts enter with their whole sets; an empty
    table gives an empty result. Other columns of docs are not read, so their names cannot clash.

    1. One pass sketches each text. Equal sets fall into one class by their digest, whatever its size.
    2. Classes meet in band buckets; each bucket compares its members with its least one only.
    3. Links are confirmed on full sets, recomputed from one text of each class that stands in a candidate pair.
    4. Where a bucket still holds several components, a link may join two members neither of which is near the bucket's
       least one. Such members are compared in blocks on their signatures, those outside a bucket's largest component
       with all; what is near by them forms families, and within these full sets are compared in blocks the same way.
       Only edges that join two components leave a block, so no step makes all pairs of a group.
    """
    out = grouped(docs, id_col, text_col, width, percent)
    group = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("id"))
    out = out.select("id", "n_shingles", group.alias("component_id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each group that near_duplicates finds: the one of the smallest id, nulls last, and among
    rows of that id the one of the smallest text hash. Repeated rows leave one. Rows without words (null, empty or blank
    text) stay as they are, and so does an empty table; other columns stay whatever their names are."""
    out = grouped(docs, id_col, text_col, width, percent)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("x")
    winners = out.where("n_shingles > 0").groupBy("c").agg(first).select(F.col("x.id").alias("_wid"), F.col("x.t").alias("_wt"), F.lit(True).alias("_one"))
    wordless = out.where("n_shingles = 0").select(F.col("id").alias("_wid"), F.col("t").alias("_wt"), F.lit(False).alias("_one")).distinct()
    keep = staged(winners.union(wordless), "kept")
    keyed = wrapped(docs, _id=id_col, _t=text_col).select("_row", F.col("_id").cast("long").alias("_id"), F.xxhash64(F.col("_t").cast("string")).alias("_t"))
    both = keyed.join(keep, keyed["_id"].eqNullSafe(keep["_wid"]) & (keyed["_t"] == keep["_wt"]))
    turn = F.row_number().over(W.partitionBy("_id", "_t").orderBy(F.lit(0)))
    return unwrapped(both.withColumn("_turn", turn).where("_turn = 1 or not _one"))


def grouped(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """Per row of docs: id, t (hash of the text), n_shingles and, if it has any, c (its group) and least (its id)."""
    ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t"), text.cast("binary").alias("text"))
    sketch = staged(texts.mapInArrow(sketches(width), SKETCH), "sketch")
    one = F.min_by(F.struct("id", "bands", "sig"), F.coalesce("id", F.lit(2**63 - 1))).alias("x")
    classes = staged(sketch.where("n_shingles > 0").groupBy("d1", "d2").agg(one).select(F.col("d1").alias("k"), "d2", "x.*"), "classes")
    slots = classes.select("k", F.explode("bands").alias("key"))
    leaders = slots.groupBy("key").agg(F.min("k").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    members = staged(slots.join(leaders, "key").select("key", "a", F.col("k").alias("b")), "buckets")
    tested = members.where("a <> b").select("a", "b").distinct()
    links = staged(confirmed(tested, classes, texts, width, percent), "links")
    groups = staged(components(links), "groups")

    placed = members.select("key", F.col("b").alias("node")).join(groups, "node", "left")
    placed = placed.select(F.col("key").alias("g"), F.col("node").alias("k"), F.coalesce("component", "node").alias("c"))
    rest = staged(blocks(staged(placed, "placed")).join(classes.select("k", "sig"), "k").select("g", "m", "p", "k", "c", "small", F.col("sig").alias("data")), "rest")
    near = staged(in_blocks(rest).mapInArrow(near_in_block(floor_of(percent)), EDGE), "near")
    if not near.isEmpty():
        families = components(near).select(F.col("component").alias("g"), F.col("node").alias("k"))
        families = families.join(groups.withColumnRenamed("node", "k"), "k", "left").select("g", "k", F.coalesce("component", "k").alias("c"))
        apart = staged(blocks(staged(families, "families")), "apart")
        sets = staged(sets_of(apart.select("k").distinct(), classes, texts, width), "sets")
        full = apart.join(sets, "k").select("g", "m", "p", "k", "c", "small", F.col("hashes").alias("data"))
        more = staged(in_blocks(full).mapInArrow(alike_in_block(percent), EDGE), "links")
        groups = staged(components(links.union(more)), "groups")

    named = classes.select("k", "d2", "id").join(groups.withColumnRenamed("node", "k"), "k", "left")
    named = named.select("k", "d2", "id", F.coalesce("component", "k").alias("c"))
    least = named.groupBy("c").agg(F.min("id").alias("least"))
    named = named.join(least, "c").select(F.col("k").alias("d1"), "d2", "c", "least")
    return sketch.select("id", "t", "n_shingles", "d1", "d2").join(named, ["d1", "d2"], "left").select("id", "t", "n_shingles", "c", "least")


def floor_of(percent: int) -> float:
    """Signatures of sets that reach percent agree in more than this share of the slots: five standard deviations."""
    return percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / SLOTS) ** 0.5


def confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that reach percent on their full sets; their signatures are compared first."""
    sig = lambda x: classes.select(F.col("k").alias(x), F.col("sig").alias(f"sig_{x}"))
    near = pairs.join(sig("b"), "b").join(sig("a"), "a").select("a", "b", "sig_a", "sig_b")
    near = staged(near.mapInArrow(near_agreement(floor_of(percent)), EDGE), "candidates")
    keys = near.select(F.col("a").alias("k")).union(near.select(F.col("b").alias("k"))).distinct()
    sets = staged(sets_of(keys, classes, texts, width), "sets")
    side = lambda x: sets.select(F.col("k").alias(x), F.col("hashes").alias(f"h{x}"))
    both = near.join(side("b"), "b").join(side("a"), "a")
    same = F.size(F.array_intersect("ha", "hb"))
    return both.where(100 * same >= percent * (F.size("ha") + F.size("hb") - same)).select("a", "b")


def sets_of(keys: DataFrame, classes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The full sets (k, hashes) of the classes in keys, from the text of one document of each."""
    ids = classes.join(keys, "k", "left_semi").select("id").distinct()
    found = texts.join(ids, texts["id"].eqNullSafe(ids["id"]), "left_semi").select("text")
    return found.mapInArrow(full_sets(width), "k long, hashes array<long>").dropDuplicates(["k"])


EDGE = "a long, b long"
SMALL_SIDE, OTHER_SIDE = 128, 512


def blocks(rows: DataFrame) -> DataFrame:
    """rows (g, k, c): members k of groups g with their components c, to the blocks (g, m, p) in which they are compared.

    Groups of one component go. The members outside a group's largest component are its small side, dealt into parts m;
    all members are its other side, dealt into parts p. Each block holds one part of either: a member stands in as many
    blocks as the opposite side has parts. Repeated rows count once.
    """
    sized = rows.distinct().groupBy("g", "c").agg(F.count("*").alias("n"))
    sizes = sized.groupBy("g").agg(F.max(F.struct("n", "c")).alias("big"), F.sum("n").alias("n"), F.count("*").alias("cs")).where("cs > 1")
    parts = lambda n, size: F.ceil(n / size).cast("int")
    sizes = sizes.select("g", F.col("big.c").alias("big"), parts(F.col("n") - F.col("big.n"), SMALL_SIDE).alias("ms"), parts(F.col("n"), OTHER_SIDE).alias("ps"))
    with_sizes = rows.distinct().join(sizes, "g")
    own = lambda n: F.pmod(F.xxhash64("k"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    small = with_sizes.where("c <> big").select("g", own("ms").alias("m"), every("ps").alias("p"), "k", "c", F.lit(True).alias("small"))
    other = with_sizes.select("g", every("ms").alias("m"), own("ps").alias("p"), "k", "c", F.lit(False).alias("small"))
    return small.union(other)


def in_blocks(rows: DataFrame) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "g", "m", "p").sortWithinPartitions("g", "m", "p")


def each_block(batches):
    """The blocks of a partition sorted by (g, m, p), as tables; one block is held at a time."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("g", "m", "p")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(keys[:, lo])
            if now != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def joining(hits):
    """Of the edges (x, y), those that join two parts that the earlier ones left apart."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for x, y in hits:
        a, b = top(x), top(y)
        if a != b:
            up[a] = b
            yield x, y


def edges_of(found) -> pa.RecordBatch:
    found = list(found)
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])


def near_in_block(floor: float):
    """Edges that join what is near by signature, across components."""

    def hits(t: pa.Table):
        k, c, small = (t.column(x).to_numpy() for x in ("k", "c", "small"))
        sig = np.frombuffer(b"".join(t.column("data").to_pylist()), np.uint8).reshape(-1, SLOTS)
        others = np.flatnonzero(~small)
        for i in np.flatnonzero(small).tolist():
            same = (sig[others] == sig[i]).mean(axis=1)
            for j in others[(same >= floor) & (c[others] != c[i])].tolist():
                yield int(k[i]), int(k[j])

    def run(batches):
        for t in each_block(batches):
            yield edges_of(joining(hits(t)))

    return run


def alike_in_block(percent: int):
    """Edges that join components by links confirmed on full sets."""

    def hits(t: pa.Table):
        k, c, small = (t.column(x).to_numpy() for x in ("k", "c", "small"))
        data = t.column("data").combine_chunks()
        flat, off = data.values.to_numpy(), data.offsets.to_numpy()
        sizes = np.diff(off)
        for i in np.flatnonzero(small).tolist():
            own = flat[off[i] : off[i + 1]]
            own = np.sort(own)
            at = np.minimum(np.searchsorted(own, flat[off[0] : off[-1]]), len(own) - 1)
            common = np.add.reduceat((own[at] == flat[off[0] : off[-1]]).astype(np.int64), off[:-1] - off[0])
            link = (100 * common >= percent * (sizes + len(own) - common)) & (c != c[i])
            for j in np.flatnonzero(link).tolist():
                yield int(c[i]), int(c[j])

    def run(batches):
        for t in each_block(batches):
            yield edges_of(joining(hits(t)))

    return run
