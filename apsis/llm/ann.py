"""Approximate nearest neighbours by inner product on shifted space-filling curves.

A coordinate that brings every vector to one length turns the largest inner product into the nearest direction. Vectors are
projected onto a few random directions, shifted and put in Hilbert order, several times with other directions and shifts.
Every order is range-partitioned at its key's quantiles; a query looks through the window of blocks around its own key on
every curve used, each block and the queries at it give matrix products, and what they find is merged and ranked exactly.

How many curves are used and how wide their windows are follows from the data: for a bounded sample of queries the true
neighbours are found first, and the cheapest windows that hold TARGET of them are taken. Where vectors have no structure
that an order could keep (uniform directions), the cheapest way is one order looked through as a whole, each pair once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Curves to choose from, directions of each and bits of a coordinate.
CURVES, DIRECTIONS, BITS = 24, 3, 10
#: Rows on which ranges and borders are fitted and queries whose true neighbours set the windows: bounds, at any size.
SAMPLE_ROWS, SAMPLE_QUERIES = 20_000, 200
#: Share of the sampled queries' neighbours that windows must hold.
TARGET = 0.96
#: Products per pair from which an order is looked through as a whole.
WHOLE = 0.75
#: What a further copy of every vector weighs, in products per pair.
COPY = 0.01
#: Blocks of an order at most, the blocks a window should have, and rows of a block at least.
BLOCKS, WINDOW_BLOCKS, LEAST_ROWS = 1024, 8, 400
#: Candidates and queries in one group.
PART_ROWS, PART_QUERIES = 10_000, 5_000
SEED = 7


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of points with integer coordinates below 2**bits (rows of cells).

    Coordinates are untwisted from the highest bit down, then Gray-coded and interleaved (Skilling, 2004).
    """
    x = [c.astype(np.int64) for c in cells.T]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(len(x)):
            up = (x[i] >> b & 1).astype(bool)
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap
            x[0] = x[0] ^ np.where(up, low, swap)
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ flip) >> b & 1)
    return key


@dataclass
class Curves:
    """Directions, shifts and ranges of all curves for one dimension, and the longest vector's length: fixed in size."""

    directions: np.ndarray  # curves x (dimension + 1) x DIRECTIONS
    shifts: np.ndarray  # curves x DIRECTIONS, shares of the range
    longest: float
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    @classmethod
    def drawn(cls, dimension: int, longest: float, seed: int = SEED) -> Curves:
        rng = np.random.default_rng(seed)
        k = min(DIRECTIONS, dimension + 1)
        directions = np.stack([np.linalg.qr(rng.standard_normal((dimension + 1, k)))[0] for _ in range(CURVES)])
        return cls(directions, 0.3 * rng.random((CURVES, k)), longest)

    def project(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Projections of candidates brought to length one, or of queries' directions: curves x rows x DIRECTIONS."""
        norm = np.linalg.norm(x, axis=1)
        x = x / norm[:, None] if query else x / self.longest
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, 1 - (norm / self.longest) ** 2))
        return np.einsum("nd,cdk->cnk", np.column_stack([x, rest]), self.directions, optimize=True)

    def fit(self, x: np.ndarray) -> None:
        p = self.project(x)
        self.low, self.high = p.min(axis=1), p.max(axis=1)

    def keys(self, projected: np.ndarray) -> np.ndarray:
        """Keys of projections, curve by curve; what lies beyond the ranges goes to their edge."""
        c = len(projected)
        span = np.maximum(self.high - self.low, 1e-12)[:c, None, :]
        share = ((projected - self.low[:c, None, :]) / span + self.shifts[:c, None, :]) / 1.3
        cells = np.clip(share * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
        return np.stack([hilbert_keys(x, BITS) for x in cells])


@dataclass
class Plan:
    """Curves used, keys at which each is cut into blocks, blocks looked at on either side, and where queries are placed."""

    curves: int
    borders: np.ndarray  # curves x (blocks - 1)
    reach: int
    place: float

    @property
    def blocks(self) -> int:
        return self.borders.shape[1] + 1

    def products(self) -> float:
        """Inner products per query and row: those of the blocks looked at."""
        return self.curves * min(1.0, (2 * self.reach + 1) / self.blocks)


def plan_for(curves: Curves, sample: np.ndarray, queries: np.ndarray, neighbours: list[np.ndarray], n: int) -> Plan:
    """The cheapest windows that hold TARGET of the neighbours, in shares of each order as the sample shows it."""
    ordered = np.sort(curves.keys(curves.project(sample)), axis=1)
    if not sum(map(len, neighbours)):  # no query has a neighbour
        return _whole(ordered, n)
    owner = np.repeat(np.arange(len(queries)), [len(x) for x in neighbours])
    found = np.concatenate(neighbours)
    # Neighbours at inner product r with a query's direction lie about r along it.
    place = float(np.median((found * queries[owner]).sum(axis=1) / np.linalg.norm(queries[owner], axis=1))) / curves.longest
    at = lambda keys: np.stack([(np.searchsorted(o, k, "left") + np.searchsorted(o, k, "right")) / (2 * len(o)) for o, k in zip(ordered, keys)])
    apart = np.abs(at(curves.keys(curves.project(found))) - at(curves.keys(curves.project(queries, True) * place))[:, owner])
    best, width, used = np.inf, 1.0, 1
    for c in range(1, CURVES + 1):
        w = np.quantile(apart[:c].min(axis=0), TARGET)
        cost = c * (2 * w + 2 * w / WINDOW_BLOCKS) + COPY * c  # a window's last block reaches beyond it; a curve costs a copy
        if cost < best:
            best, width, used = cost, w, c
    if best >= WHOLE:
        return _whole(ordered, n)
    blocks = int(np.clip(WINDOW_BLOCKS / max(2 * width, 1e-9), 2, min(BLOCKS, max(2, n // LEAST_ROWS))))
    return Plan(used, _borders(ordered[:used], blocks), int(np.ceil(width * blocks)), place)


def _borders(ordered: np.ndarray, blocks: int) -> np.ndarray:
    return ordered[:, (np.arange(1, blocks) * ordered.shape[1]) // blocks]


def _whole(ordered: np.ndarray, n: int) -> Plan:
    blocks = max(1, min(BLOCKS, n // PART_ROWS))
    return Plan(1, _borders(ordered[:1], blocks), blocks, 0.0)


def usable(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """``id, v, query``: rows with an id and a vector of finite components, not all zero."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"), "query").where("id is not null and v is not null")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else np.concatenate([np.asarray(v) for v in column])
    return np.asarray(flat, np.float64).reshape(len(column), -1)


def _sample(rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of at most so many rows, in order of a hash of their ids."""
    found = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(most).toArrow().combine_chunks()
    return found.column("id").to_numpy(), _matrix(found.column("v").combine_chunks()) if len(found) else np.empty((0, 0))


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """``query, row, score``: places of the k rows with the largest inner product for each query, its own id left out."""
    for start in range(0, len(q), 256):
        for i, s in enumerate(q[start : start + 256] @ x.T, start):
            s[ids == q_ids[i]] = -np.inf
            least = np.partition(s, -k)[-k] if len(s) > k else -np.inf
            # Products may round otherwise than the exact score, by a share of the lengths.
            at = np.flatnonzero((s >= least - 1e-12 * len(q[i]) * np.abs(s[np.isfinite(s)]).max(initial=0.0) - 1e-300) & (s > -np.inf))
            exact = (x[at] * q[i]).sum(axis=1)
            best = np.lexsort((ids[at], -exact))[:k]
            yield i, at[best], exact[best]


def _true_neighbours(rows: DataFrame, q_ids: np.ndarray, q: np.ndarray, k: int) -> list[np.ndarray]:
    """Vectors of the sampled queries' k nearest rows among all: k by task, then over tasks."""

    def work(batches):
        for b in batches:
            if b.num_rows:
                x, ids = _matrix(b.column("v")), b.column("id").to_numpy()
                for i, at, score in _best(q_ids, q, ids, x, k):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i)), pa.array(score), pa.array(ids[at]), pa.array(list(x[at]), pa.list_(pa.float64()))], names=["i", "score", "id", "v"])

    order = Window.partitionBy("i").orderBy(F.desc("score"), "id")
    best = rows.select("id", "v").mapInArrow(work, "i long, score double, id long, v array<double>").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    found = best.select("i", "v").toPandas()  # SAMPLE_QUERIES x k vectors at most
    return [np.stack(v) if len(v := found.loc[found["i"] == i, "v"].tolist()) else np.empty((0, q.shape[1])) for i in range(len(q))]


def fit(rows: DataFrame, dimension: int, k: int) -> tuple[Curves, Plan]:
    """Curves and windows for usable rows of one dimension."""
    n, longest = rows.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    curves = Curves.drawn(dimension, longest)
    _, sample = _sample(rows, SAMPLE_ROWS)
    curves.fit(sample)
    q_ids, q = _sample(rows.where("query"), SAMPLE_QUERIES)
    neighbours = _true_neighbours(rows, q_ids, q, k) if len(q) else []
    return curves, plan_for(curves, sample, q, neighbours, n)


def _nearest(rows: DataFrame, dimension: int, k: int) -> DataFrame:
    curves, plan = fit(rows, dimension, k)
    used = Curves(curves.directions[: plan.curves], curves.shifts[: plan.curves], curves.longest, curves.low, curves.high)

    def block_of(projected):
        keys = used.keys(projected)
        return np.stack([np.searchsorted(b, x, "right") for b, x in zip(plan.borders, keys)]).T.astype(np.int32)

    def placed(query: bool):
        def run(batches):
            for b in batches:
                p = used.project(_matrix(b.column("v")), query)
                own = block_of(p * plan.place if query else p)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(own.tolist(), pa.list_(pa.int32()))], names=["id", "v", "blocks"])

        return run

    made = "id long, v array<double>, blocks array<int>"
    each = lambda q: rows.where("query" if q else "true").select("id", "v").mapInArrow(placed(q), made).select("id", "v", F.posexplode("blocks").alias("curve", "own"))
    spread = F.sequence(F.greatest(F.col("own") - plan.reach, F.lit(0)), F.least(F.col("own") + plan.reach, F.lit(plan.blocks - 1)))
    candidates = each(False).withColumnRenamed("own", "block").withColumn("query", F.lit(False))
    probes = each(True).withColumn("block", F.explode(spread)).drop("own").withColumn("query", F.lit(True))
    # Rows and queries of each block: curves x blocks numbers. Both sides of a full block are cut into parts.
    counted = candidates.select("curve", "block", "query").union(probes.select("curve", "block", "query")).groupBy("curve", "block").agg(F.count_if(~F.col("query")).alias("rows"), F.count_if("query").alias("queries"))
    sizes = counted.collect()
    parts = {(r.curve, r.block): (-(-r.rows // PART_ROWS), -(-r.queries // PART_QUERIES)) for r in sizes}
    table = [(c, b, *p) for (c, b), p in parts.items() if min(p) > 0]
    cuts = F.broadcast(rows.sparkSession.createDataFrame(table, "curve int, block int, cut0 int, cut1 int"))  # curves x blocks rows at most

    def dealt(side_rows, own, other):
        """Rows with their part on their own side, once for every part of the other."""
        met = side_rows.join(cuts, ["curve", "block"])
        return met.withColumn("_own", F.pmod(F.xxhash64("id"), F.col(f"cut{own}")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(f"cut{other}") - 1)))

    place = ["curve", "block", "part", "query_part"]
    left = dealt(candidates, 0, 1).withColumnRenamed("_own", "part").withColumnRenamed("_other", "query_part")
    right = dealt(probes, 1, 0).withColumnRenamed("_own", "query_part").withColumnRenamed("_other", "part")
    both = left.select("id", "v", "query", *place).union(right.select("id", "v", "query", *place))
    tasks = 1 + sum(r.rows * parts[r.curve, r.block][1] + r.queries * parts[r.curve, r.block][0] for r in sizes) // (4 * PART_ROWS)

    def rank(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = pdf["query"].to_numpy(bool)
        out = [pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})]
        if asked.any() and not asked.all():
            ids, q_ids = pdf["id"].to_numpy()[~asked], pdf["id"].to_numpy()[asked]
            for i, at, score in _best(q_ids, _matrix(pdf["v"][asked]), ids, _matrix(pdf["v"][~asked]), k):
                out.append(pd.DataFrame({"query_id": q_ids[i], "vec_id": ids[at], "score": score}))
        return pd.concat(out)

    return both.repartitionByRange(tasks, *place).groupBy(*place).applyInPandas(rank, "query_id long, vec_id long, score double")


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row the k rows found with the largest inner product.

    is_query is a condition on df's columns. Ties go to the smaller id; a row is no neighbour of a query of its own id;
    rows that share an id count once, with their best score. Vectors that are null, zero or hold null or non-finite
    components, and rows without id, take no part; vectors of different lengths have no inner product, so each length is
    searched by itself. With fewer rows than k all are returned; an empty table gives none.
    """
    marked = df.withColumn("query", F.coalesce(is_query, F.lit(False)))
    rows = written(usable(marked, id_col, vector))
    found = df.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    for r in rows.where("query").groupBy(F.size("v").alias("size")).count().orderBy("size").collect():  # one row a length
        found = found.union(_nearest(rows.where(F.size("v") == r["size"]), r["size"], k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order))
    return merged.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
