"""Near duplicates among vectors by an inverted multi-index with multi-sequence traversal."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillforge.llm.common import components, ship, staged, unstage
from fillforge.llm.minhash import each_block, joining

TRAIN = 8192  # vectors at least that the codebooks are fitted on, 16 per centroid beyond that
QUERIES = 256  # vectors whose neighbours among all rows are found by brute force to set the traversal's length
MOST_QUERIES, LINKED = 4096, 64  # more are drawn, up to so many, until so many of them have links
LEAST_CELLS, SPARE = 8, 4  # cells that a traversal visits at least; times the rank that reached the target recall
PART = 512  # rows of a side of a block


def unit(rows) -> np.ndarray:
    x = np.asarray(rows, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def stacked(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


class MultiIndex:
    """Two codebooks, one per half of a vector; a cell is a pair of centroids. Distances are whole numbers, so that
    every task orders the cells of a vector alike."""

    def __init__(self, sample: np.ndarray, k: int, rounds: int = 12):
        self.half = sample.shape[1] // 2
        rng = np.random.default_rng(3)
        self.books = [self.fit(part, min(k, len(sample)), rng, rounds) for part in (sample[:, : self.half], sample[:, self.half :])]

    @staticmethod
    def fit(x: np.ndarray, k: int, rng, rounds: int) -> np.ndarray:
        book = x[rng.choice(len(x), k, replace=False)].copy()
        for _ in range(rounds):
            near = ((book**2).sum(1) - 2 * x @ book.T).argmin(1)
            total = np.zeros_like(book)
            np.add.at(total, near, x)
            n = np.bincount(near, minlength=k)[:, None]
            book = np.where(n > 0, total / np.maximum(n, 1), book)
        return book

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for part, book in zip((x[:, : self.half], x[:, self.half :]), self.books, strict=True):
            d = (part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1)
            out.append(np.rint(d * 2**24).astype(np.int64))
        return out[0], out[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * len(self.books[1]) + b.argmin(1)

    def nearest(self, x: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
        """Multi-sequence traversal: the `cells` nearest cells of each vector, and the distance of the last one.

        The cell of the r-th and s-th nearest centroid (from 1) comes after r * s - 1 others at least, so only pairs of
        ranks with r * s <= cells can be visited.
        """
        a, b = self.distances(x)
        oa, ob = np.argsort(a, 1, kind="stable")[:, :cells], np.argsort(b, 1, kind="stable")[:, :cells]
        r, s = np.array([(i, j) for i in range(oa.shape[1]) for j in range(ob.shape[1]) if (i + 1) * (j + 1) <= cells]).T
        row = np.arange(len(x))[:, None]
        total = a[row, oa[:, r]] + b[row, ob[:, s]]
        take = np.argsort(total, 1, kind="stable")[:, :cells]
        return (oa[:, r] * len(self.books[1]) + ob[:, s])[row, take], total[row, take][:, -1]

    def ranks(self, x: np.ndarray, which: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells are nearer to the vector x[w] than the cell c, for each w of which and c of cells. Distances are
        sorted once per vector; equal pairs should be put together before."""
        a, b = self.distances(x)
        i, j = np.divmod(cells, len(self.books[1]))
        out = np.zeros(len(cells), np.int64)
        for w in np.unique(which).tolist():
            at = np.flatnonzero(which == w)
            gaps = (a[w, i[at]] + b[w, j[at]])[:, None] - a[w]
            out[at] = np.searchsorted(np.sort(b[w]), gaps.ravel(), side="left").reshape(gaps.shape).sum(axis=1)
        return out


def ranks_of_neighbours(index: MultiIndex, queries: np.ndarray, least: float):
    """All vectors against the queries: how many links a query has at which rank of the cell that holds the other one."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = unit(stacked(batch.column(0)))
                cos = queries @ x.T
                q, y = np.nonzero((cos >= least) & (cos < 1 - 1e-12))  # not the query itself: classes are distinct
                pairs, n = np.unique(np.stack([q, index.cells(x)[y]], axis=1), axis=0, return_counts=True)
                both = np.stack([pairs[:, 0], index.ranks(queries, pairs[:, 0], pairs[:, 1])], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(n, pa.int64())], ["query", "rank", "n"])

    return run


def planted_ranks(index: MultiIndex, queries: np.ndarray, least: float, seed: int = 5) -> list[dict]:
    """As ranks_of_neighbours gives them, for one made-up neighbour of each query at a cosine between least and 1: what the
    index does to links is known even where a table has few."""
    rng = np.random.default_rng(seed)
    away = rng.normal(size=queries.shape)
    away = unit(away - (away * queries).sum(axis=1, keepdims=True) * queries)
    cos = rng.uniform(least, 1, (len(queries), 1))
    at = np.arange(len(queries))
    found = index.ranks(queries, at, index.cells(cos * queries + np.sqrt(1 - cos**2) * away))
    return [{"query": q, "rank": r, "n": 1} for q, r in zip(at.tolist(), found.tolist(), strict=True)]


def cells_to_visit(ranks: list, recall: float) -> tuple[int, int]:
    """How many queries have links, and how many cells reach the target recall for that share of them: each query counts
    alike, so that a large group of near copies does not speak for the rest. ranks: (query, rank, n) by query and rank."""
    need: dict[int, int] = {}
    total: dict[int, int] = {}
    for r in ranks:
        total[r["query"]] = total.get(r["query"], 0) + r["n"]
    got = dict.fromkeys(total, 0)
    for r in ranks:
        q = r["query"]
        if got[q] < recall * total[q]:
            got[q] += r["n"]
            need[q] = r["rank"] + 1
    return len(need), int(np.quantile(list(need.values()), recall, method="higher")) if need else 0


def visit(index: MultiIndex, cells: int):
    """(k, n, v) to a row (g = cell, visits = False) for the index and one (visits = True) per visited cell."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                x = unit(stacked(part.column(2)))
                near, last = index.nearest(x, cells)
                own = index.cells(x)
                at = np.concatenate([np.arange(len(x)), np.repeat(np.arange(len(x)), near.shape[1])])
                picked = part.take(pa.array(at))
                more = [pa.array(np.concatenate([own, near.ravel()])), pa.array(np.arange(len(at)) >= len(x)), pa.array(own[at]), pa.array(last[at])]
                yield pa.RecordBatch.from_arrays([*picked.columns, *more], ["k", "n", "v", "g", "visits", "cell", "last"])

    return run


def link(index: MultiIndex, least: float):
    """Blocks of visitors and members of a cell to link counts per vector and to edges that join all that is linked.

    A link of x and y shows up where x visits y's cell and where y visits x's. x counts it in the first place; y counts
    it there only if it does not visit x's cell itself.
    """

    def run(batches):
        for t in each_block(batches):
            visits = t.column("visits").to_numpy()
            data = t.column("v").combine_chunks()
            x = unit(stacked(data))
            k, n, cell, last = (t.column(c).to_numpy() for c in ("k", "n", "cell", "last"))
            a, b = np.flatnonzero(visits), np.flatnonzero(~visits)
            if not len(a) or not len(b):
                continue
            hit = (x[a] @ x[b].T >= least) & (k[a][:, None] != k[b][None])
            rows, cols = np.nonzero(hit)
            if not len(rows):
                continue
            da, db = index.distances(x[b])
            i, j = np.divmod(cell[a], len(index.books[1]))
            mutual = da[:, i].T + db[:, j].T <= last[b][None]
            count_a = hit @ n[b]
            count_b = n[a] @ (hit & ~mutual)
            edges = list(joining(zip(k[a][rows].tolist(), k[b][cols].tolist(), strict=True)))
            out = [(int(k[a][r]), None, int(c)) for r, c in enumerate(count_a) if c] + [(int(k[b][r]), None, int(c)) for r, c in enumerate(count_b) if c] + [(p, q, 0) for p, q in edges]
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(3)], ["a", "b", "n"])

    return run


def embedding_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, recall: float = 0.99) -> DataFrame:
    """Groups of vectors whose cosine is at least `least`.

    Returns one row per row of vectors: id, n_links (other vectors linked directly), component_id (smallest id reachable
    by links, the own one included) and kept (id = component_id). Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing and keep their id; vectors of different lengths do not link. A row without
    id takes part but names no group. Vectors that are equal once divided by their largest component form one class,
    however many; each row of a class links with all others. An empty table gives an empty result. Labels and other
    columns are not read, so their names cannot clash.

    Each length is indexed apart, by the jobs of linked(). Classes are told apart by a 64-bit hash of their vector.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    good = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    largest = F.array_max(F.transform("v", F.abs))
    rows = rows.select("id", F.when(good, F.transform("v", lambda x: x / largest + 0.0)).alias("v"))  # + 0.0: no negative zeros
    rows = staged(rows.select("id", F.when(F.col("v").isNotNull(), F.xxhash64(F.size("v"), "v")).alias("k"), "v"), "vectors")
    classes = staged(rows.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.first("v").alias("v")), "classes")
    sizes = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()
    edge = "a long, b long, n long"
    found = classes.sparkSession.createDataFrame([], edge)
    for r in sizes:
        if r["d"] > 1 and r["n"] > 1:  # the two classes of length 1 are opposite
            found = found.union(linked(classes.where(F.size("v") == r["d"]), r["n"], least, recall))
    groups = staged(components(found.where("b is not null").select("a", "b")), "groups")
    counts = found.where("b is null").groupBy(F.col("a").alias("k")).agg(F.sum("n").alias("more"))
    named = classes.select("k", "n", "id").join(counts, "k", "left").join(groups.withColumnRenamed("node", "k"), "k", "left")
    named = named.select("k", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "id", F.coalesce("component", "k").alias("c"))
    names = named.groupBy("c").agg(F.min("id").alias("component_id"))
    named = named.join(names, "c").select("k", "n_links", "component_id")
    out = rows.select("id", "k").join(named, "k", "left")
    group = F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("component_id"))
    out = out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), group.alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def linked(classes: DataFrame, total: int, least: float, recall: float) -> DataFrame:
    """Links among `total` classes (k, n, v) of one length: rows (a, null, links of a's rows with other classes) and edges
    (a, b, 0) that join all that is linked.

    Codebooks of both halves are fitted on a bounded sample; every class is indexed. A brute-force search of QUERIES
    vectors, or more where few have links, against all rows sets how many cells a traversal visits: SPARE times those
    that reach the target recall. Where too few have links at all, made-up neighbours of theirs count as well. Members and visitors of a cell meet in blocks of PART by PART; a block returns counts
    and joining edges, no pairs. A cell of N vectors is thus read N / PART times, which a cluster of near copies costs.
    """
    spark = classes.sparkSession
    k = max(2, min(4096, 2 ** round(np.log2(max(total, 16) / 4) / 2)))
    spread = F.pmod(F.xxhash64("k"), F.lit(1 << 32))

    def by_hash(n: int) -> np.ndarray:
        """The n vectors of the smallest hashes; a threshold leaves few more to be sorted."""
        few = classes.where(spread < F.lit(int(min(1.0, (1.5 * n + 200) / total) * (1 << 32))))
        return unit([r["v"] for r in few.orderBy(spread, "k").limit(n).select("v").collect()])

    index = MultiIndex(by_hash(max(TRAIN, 16 * k)), k)
    drawn, some, cells = QUERIES, 0, 0
    while True:
        queries = by_hash(drawn)
        seen = classes.select("v").mapInArrow(ranks_of_neighbours(index, queries, least), "query long, rank long, n long")
        some, cells = cells_to_visit(seen.groupBy("query", "rank").agg(F.sum("n").alias("n")).orderBy("query", "rank").collect(), recall)
        if some >= LINKED or drawn >= min(MOST_QUERIES, total):
            break
        drawn *= 4
    if some < LINKED:
        cells = max(cells, cells_to_visit(planted_ranks(index, queries, least), recall)[1])
    cells = max(LEAST_CELLS, SPARE * cells)
    cells = min(cells, len(index.books[0]) * len(index.books[1]))
    placed = staged(classes.select("k", "n", "v").mapInArrow(visit(index, cells), "k long, n long, v array<double>, g long, visits boolean, cell long, last long"), "placed")
    parts = placed.groupBy("g").agg(F.ceil(F.count_if("visits") / PART).cast("int").alias("ms"), F.ceil(F.count_if(~F.col("visits")) / PART).cast("int").alias("ps"))
    both = placed.join(parts.where("ms > 0 and ps > 0"), "g")
    own = lambda c: F.pmod(F.xxhash64("k"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    rest = ("k", "n", "v", "visits", "cell", "last")
    dealt = both.where("visits").select("g", own("ms").alias("m"), every("ps").alias("p"), *rest)
    dealt = dealt.union(both.where("not visits").select("g", every("ms").alias("m"), own("ps").alias("p"), *rest))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = staged(dealt.repartition(tasks, "g", "m", "p").sortWithinPartitions("g", "m", "p").mapInArrow(link(index, least), "a long, b long, n long"), "found")
    unstage(placed)
    return out
