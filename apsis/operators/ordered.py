"""Windows over an ordered series of any length: one without a key, or a key that holds a large share of the rows.

A window function sends all rows of a key to one task. Here rows are dealt by ranges of (key, order), so that a long
series lies in many chunks. Each chunk is scanned by itself; one row a chunk and key sums it up, those few rows are scanned in turn, and what
the chunks before hand over is added to a chunk's own result. At most one key of a chunk began in an earlier one, so what
is handed over has a row a chunk at most and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import all_of, micros
from ..sources.scratch import written

Names = list[str]
CHUNK = "_chunk"
#: Most chunks of a table, and so most rows that are broadcast or come to the driver.
MOST_CHUNKS = 20_000


def place(df: DataFrame, by: Names, order: Names, chunks: int | None = None) -> DataFrame:
    """df in chunks (``_chunk``) whose numbers go up with (by, order), nulls first; written, so that a chunk stays what it is.

    There are as many chunks as shuffle partitions unless said otherwise. Rows equal in all of by and order share a chunk.
    """
    n = min(MOST_CHUNKS, chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return written(df.repartitionByRange(n, *by, *order).withColumn(CHUNK, F.spark_partition_id()))


def scan(placed: DataFrame, by: Names, order: Names, sums: dict[str, Column] | None = None, fills: dict[str, Column] | None = None, before: Names = ()) -> DataFrame:
    """placed with running results over each key's rows so far: sums, and fills with the last value that was not null.

    ``before`` names columns of which the struct ``_before`` holds the key's previous row (null on its first). order must end in a
    unique column, as for any window; a null key is a key. Sums are null until a value was there.
    """
    sums, fills = sums or {}, fills or {}
    at = F.struct(*order)
    inner = {f"_s{i}": c for i, c in enumerate(sums.values())} | {f"_f{i}": c for i, c in enumerate(fills.values())}
    rows = placed.withColumns(inner) if inner else placed
    w = Window.partitionBy(CHUNK, *by).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = {c: F.sum(c).over(so_far) if c[1] == "s" else F.last(c, ignorenulls=True).over(so_far) for c in inner}
    totals = [F.sum(c).alias(c) if c[1] == "s" else F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in inner]
    if before:
        own["_before"] = F.lag(F.struct(*before)).over(w)
        totals.append(F.max_by(F.struct(*before), at).alias("_before"))

    ends = rows.groupBy(CHUNK, *by).agg(*totals)
    k = Window.partitionBy(*by).orderBy(CHUNK)  # without a key: a row a chunk
    earlier = k.rowsBetween(Window.unboundedPreceding, -1)
    handed = [(F.sum(c).over(earlier) if c[1] == "s" else F.last(c, ignorenulls=True).over(earlier)).alias(f"{c}_in") for c in inner]
    if before:
        handed.append(F.lag("_before").over(k).alias("_before_in"))
    carry = ends.select(F.col(CHUNK).alias("_at"), *[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)], F.row_number().over(k).alias("_i"), *handed).where("_i > 1").drop("_i")

    local = rows.withColumns(own)
    same = [F.col(CHUNK) == F.col("_at"), *[F.col(b).eqNullSafe(F.col(f"_k{i}")) for i, b in enumerate(by)]]
    joined = local.join(F.broadcast(carry), all_of(same), "left")
    out = {name: F.coalesce(F.col(c) + F.col(f"{c}_in"), c, f"{c}_in") for name, c in zip(sums, inner)}
    out |= {name: F.coalesce(c, f"{c}_in") for name, c in zip(fills, list(inner)[len(sums) :])}
    if before:
        out["_before"] = F.coalesce("_before", "_before_in")
    kept = [F.col(f"`{c}`") for c in placed.columns if c not in out]
    return joined.select(*kept, *[c.alias(name) for name, c in out.items()])


def running_sums(df: DataFrame, sums: dict[str, Column], by: Names, order: Names, chunks: int | None = None) -> DataFrame:
    """df with running sums over each key, however many rows it has."""
    return scan(place(df, by, order, chunks), by, order, sums=sums).drop(CHUNK)


def fill_series(df: DataFrame, columns: Names, order: Names, by: Names = (), chunks: int | None = None) -> DataFrame:
    """df with the gaps of columns filled by the last value before, over one long series or long keys."""
    by = list(by)
    filled = scan(place(df, by, order, chunks), by, order, fills={c: F.col(c) for c in columns})
    return filled.select(*[F.col(f"`{c}`") for c in df.columns])


#: Aggregates of whole sets that follow from those of parts: by function, what joins many parts and what joins two.
MERGES = {
    F.max: (F.max, F.greatest),
    F.min: (F.min, F.least),
    F.sum: (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    F.count: (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
}


def rolling_series(df: DataFrame, ts: str, seconds: int, aggregates: dict[str, Column | tuple], closed: bool = False, chunks: int | None = None) -> DataFrame:
    """Aggregates over the rows of the last seconds, (t - seconds, t], of one series without a key; ``closed`` takes the far end in.

    An aggregate is a pair of F.max, F.min, F.sum or F.count and what it is taken of, at a cost that doesn't depend on the window, or any
    aggregate column, which costs the rows times those of a window. A row without a time has those without one for its window.
    """
    span = seconds * 1_000_000 - (not closed)
    pairs = {out: a for out, a in aggregates.items() if isinstance(a, tuple)}
    if pairs:
        df = _rolling_parts(df, ts, span, pairs, chunks)
    if len(pairs) < len(aggregates):
        df = _rolling_rows(df, ts, span, {out: a for out, a in aggregates.items() if out not in pairs}, chunks)
    return df


def _rolling_parts(df: DataFrame, ts: str, span: int, pairs: dict[str, tuple], chunks: int | None) -> DataFrame:
    """Every window is the end of one block of time and the start of the next, as blocks are as long as a window (span + 1).

    Rows become one row an instant; at the instant a window starts there is a mark. Ends are running results from a block's last
    instant down to a mark, starts those from its first instant up. A block in several chunks takes over what its other chunks hold.
    """
    names = [f"_p{i}" for i in range(len(pairs))]
    many = [MERGES[f][0] for f, _ in pairs.values()]
    two = [MERGES[f][1] for f, _ in pairs.values()]
    timed = df.withColumn("_us", micros(ts))
    instants = timed.groupBy("_us").agg(*[f(c).alias(p) for p, (f, c) in zip(names, pairs.values())])
    kinds = {p: instants.schema[p].dataType for p in names}  # sums of decimals would widen at each step

    def block(at: Column) -> Column:
        return at - F.pmod(at, F.lit(span + 1))

    us = F.col("_us")
    begins = us - span
    marks = instants.where(block(begins) < block(us)).select("_us", begins.alias("_at"), *[F.lit(None).cast(kinds[p]).alias(p) for p in names], F.lit(True).alias("_mark"))
    both = instants.select("_us", us.alias("_at"), *names, F.lit(False).alias("_mark")).unionByName(marks)
    placed = place(both, [], ["_at"], chunks).withColumn("_block", block(F.col("_at")))

    parts = placed.groupBy(CHUNK, "_block").agg(*[m(p).cast(kinds[p]).alias(p) for p, m in zip(names, many)])
    k = Window.partitionBy("_block").orderBy(CHUNK)
    before, after = k.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_block").orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    handed = [m(p).over(w).cast(kinds[p]).alias(f"{p}{way}") for p, m in zip(names, many) for way, w in (("_before", before), ("_after", after))]
    carry = parts.select(F.col(CHUNK).alias("_c"), F.col("_block").alias("_b"), F.count(F.lit(1)).over(Window.partitionBy("_block")).alias("_n"), *handed)
    carry = F.broadcast(carry.where("_n > 1").drop("_n"))  # a chunk shares its first and last block at most

    piece = Window.partitionBy(CHUNK, "_block")
    up = piece.orderBy("_at", "_mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = piece.orderBy(F.desc("_at"), "_mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumns({f"{p}_up": m(p).over(up) for p, m in zip(names, many)}).withColumns({f"{p}_down": m(p).over(down) for p, m in zip(names, many)})
    joined = local.join(carry, (F.col(CHUNK) == F.col("_c")) & (F.col("_block") == F.col("_b")), "left")
    halves = [F.when(F.col("_mark"), join(F.col(f"{p}_down"), F.col(f"{p}_after"))).otherwise(join(F.col(f"{p}_up"), F.col(f"{p}_before"))).cast(kinds[p]).alias(p) for p, join in zip(names, two)]
    windows = joined.select(F.col("_us").alias("_w"), *halves).groupBy("_w").agg(*[m(p).cast(kinds[p]).alias(out) for out, p, m in zip(pairs, names, many)])
    return timed.join(windows, F.col("_us").eqNullSafe(F.col("_w")), "left").drop("_us", "_w")


def _rolling_rows(df: DataFrame, ts: str, span: int, aggregates: dict[str, Column], chunks: int | None) -> DataFrame:
    """Any aggregates, each window row by row. Rows of one time share a chunk; a chunk also gets copies of the rows that its
    first times look back to: a row is copied to as many chunks as the time after it spans.
    """
    placed = place(df.withColumn("_us", micros(ts)), [], ["_us"], chunks)
    bounds = sorted(tuple(r) for r in placed.where("_us is not null").groupBy(CHUNK).agg(F.min("_us"), F.max("_us")).collect())  # a row a chunk
    reach, to = [], 0
    for i, (chunk, first, last) in enumerate(bounds):
        to = max(to, i)
        while to + 1 < len(bounds) and bounds[to + 1][1] - span <= last:
            to += 1
        reach.append((chunk, i, to, first))
    table = F.broadcast(df.sparkSession.createDataFrame(reach, f"{CHUNK} int, _i int, _to int, _first long"))  # a row a chunk
    copies = placed.join(table.where("_to > _i").drop("_first"), CHUNK).withColumn("_i", F.explode(F.sequence(F.col("_i") + 1, F.col("_to")))).drop(CHUNK, "_to")
    copies = copies.join(table.drop("_to"), "_i").where(F.col("_first") - span <= F.col("_us")).withColumn("_copy", F.lit(True)).drop("_i", "_first")
    w = Window.partitionBy(CHUNK).orderBy("_us").rangeBetween(-span, 0)
    both = placed.withColumn("_copy", F.lit(False)).unionByName(copies)
    return both.withColumns({out: a.over(w) for out, a in aggregates.items()}).where("not _copy").drop("_copy", "_us", CHUNK)
