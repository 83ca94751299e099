"""Repair of damaged conversations by shortest paths in Dial's bucket queue.

A conversation's rows are the layers of a graph with four states in each: nothing said yet, the system has spoken, the user
has, the assistant has. Arcs keep, rerole or delete a row or insert one, at costs of 0 to 6, so a ring of buckets replaces a heap.
Distances to the end are recorded; a walk from the start along tight arcs, the least letter first, gives the cheapest audit
that is least in ASCII order. Rows that must go are no layers: their D comes before all else that is tight there.

Small conversations are solved whole, many in one sorted stream. A conversation of any size is cut into chunks by the order
of its rows: each chunk is summed up by its distances between states (16 numbers), the sums are joined from the end, and
chunks are then walked apart. One thing stays in order, as its definition asks: the SHA-256 of a conversation's text.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: What is solved whole; beyond either a conversation is cut into chunks of about so many rows.
WHOLE_ROWS, WHOLE_BYTES = 20_000, 16_000_000

# Costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
DEAREST = REROLE + TRUNCATED
START, SYSTEM, USER, ASSISTANT = range(4)
#: From a state, the state that the initial of a kept row's role leads to.
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: From a state, the one that a new or reroled row leads to: the user and the assistant are the only roles to choose from.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: From a state, the cost of ending there, by inserts alone.
ENDS = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 60

Layer = tuple[str, bool]


def distances(layers: list[Layer], exits: Iterable[int] = ENDS) -> list[int]:
    """Distance to the end from node ``4 * layer + state``, layers being (role's initial, truncated); exits: those behind the last layer.

    Dial's algorithm from the end backwards: nodes settle in order of distance, each from the bucket of its distance in a ring.
    """
    n, exits = len(layers), list(map(int, exits))
    far = [FAR] * (4 * n) + exits
    least, most = min(exits), max((e for e in exits if e < FAR), default=0)
    ring: list[list[int]] = [[] for _ in range(max(DEAREST, most - least) + 1)]
    waiting = 0
    for q, e in enumerate(exits):
        if e < FAR:
            ring[e % len(ring)].append(4 * n + q)
            waiting += 1
    at = least
    while waiting:
        bucket = ring[at % len(ring)]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if far[node] != at:
                continue  # found nearer meanwhile
            layer, state = divmod(node, 4)
            arcs = []
            if layer < n:
                arcs += [(node - state + q, INSERT) for q in range(4) if NEXT[q] == state]
            if layer:
                initial, cut = layers[layer - 1]
                more, before = TRUNCATED * cut, node - state - 4
                arcs.append((before + state, DELETE))
                for q in range(4):
                    if KEPT[q].get(initial) == state:
                        arcs.append((before + q, KEEP + more))
                    if NEXT[q] == state:
                        arcs.append((before + q, REROLE + more))
            for other, cost in arcs:
                if at + cost < far[other]:
                    far[other] = at + cost
                    ring[(at + cost) % len(ring)].append(other)
                    waiting += 1
        at += 1
    return far


def walk(layers: list[Layer], gone: list[int], far: list[int], state: int) -> Iterator[tuple[str, int, int]]:
    """``letters, layer, state after``: from a state before the first layer along tight arcs, the least letter first.

    gone: rows that must go before each layer, and after the last; their letters come together. Behind the last layer the walk stops.
    """
    for layer, (initial, cut) in enumerate(layers):
        if gone[layer]:
            yield "D" * gone[layer], -1, state
        more = TRUNCATED * cut
        while True:
            left, after = far[4 * layer + state], 4 * (layer + 1)
            if far[after + state] + DELETE == left:
                yield "D", layer, state
                break
            if far[4 * layer + NEXT[state]] + INSERT == left:
                state = NEXT[state]
                yield "I", -1, state
                continue
            kept = KEPT[state].get(initial)
            if kept is not None and far[after + kept] + KEEP + more == left:
                state = kept
                yield "K", layer, state
                break
            state = NEXT[state]
            yield "R", layer, state
            break
    if gone[-1]:
        yield "D" * gone[-1], -1, state


def ending(state: int) -> Iterator[tuple[str, int, int]]:
    """The inserts behind the last row."""
    while ENDS[state]:
        state = NEXT[state]
        yield "I", -1, state


def layered(rows: Iterable[tuple]) -> tuple[list[Layer], list[int], list[tuple[str, str]], int, list[str]]:
    """Layers, rows gone before each, (role, text) of each, illegal neighbours, and the initials at both ends, of rows.

    A row is (role, text, times, must, truncated); only the first of its times can stay, as the others repeat it.
    """
    layers, gone, said, illegal, ends, last = [], [0], [], 0, [], None
    for role, text, times, must, cut in rows:
        initial = role[:1]
        if last is not None:
            illegal += last + initial not in ("su", "ua", "au")
        illegal += times - 1
        ends = [ends[0] if ends else initial, initial]
        last = initial
        if must:
            gone[-1] += times
        else:
            layers.append((initial, bool(cut)))
            said.append((role, text))
            gone.append(times - 1)
    return layers, gone, said, illegal, ends


def lines(steps: Iterable[tuple[str, int, int]], said: list[tuple[str, str]]) -> Iterator[tuple[str, str | None]]:
    """Each step's letter and its line of the repaired conversation, None where it has none."""
    for letter, layer, state in steps:
        if letter[0] == "D":
            yield letter, None
        elif letter == "I":
            yield letter, f"{ROLE[state]}:"
        else:
            yield letter, f"{said[layer][0] if letter == 'K' else ROLE[state]}:{said[layer][1]}"


class Digest:
    """SHA-256 of lines joined by newlines, as they come."""

    def __init__(self):
        self.sha, self.begun = hashlib.sha256(), False

    def add(self, line: str) -> None:
        self.sha.update(("\n" if self.begun else "").encode() + line.encode())
        self.begun = True


_ROW = ["role", "text", "times", "must", "truncated"]


def _groups(batches: Iterable[pd.DataFrame], by: list[str], columns: list[str]) -> Iterator[tuple]:
    """Runs of rows with equal ``by`` in sorted batches; a run may go on in the next batch."""
    rows = (r for pdf in batches for r in zip(zip(*[pdf[c] for c in by]), *[pdf[c] for c in columns]))
    for key, own in itertools.groupby(rows, lambda r: r[0]):
        yield key, (r[1:] for r in own)


def _solve_whole(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = []
    for (k,), rows in _groups(batches, ["k"], _ROW):
        layers, gone, said, illegal, _ = layered(rows)
        far, audit, digest, state = distances(layers), [], Digest(), START
        steps = list(walk(layers, gone, far, START))
        state = steps[-1][2] if steps else START
        for letter, line in lines([*steps, *ending(state)], said):
            audit.append(letter)
            if line is not None:
                digest.add(line)
        out.append((k, illegal, far[START] + DELETE * sum(gone), "".join(audit), digest.sha.hexdigest()))
        if len(out) == 1000:
            yield pd.DataFrame(out, columns=_SOLVED_NAMES)
            out = []
    yield pd.DataFrame(out, columns=_SOLVED_NAMES)


_SOLVED = "k string, illegal long, cost long, audit string, repaired_sha256 string"
_SOLVED_NAMES = [c.split()[0] for c in _SOLVED.split(", ")]


def _sum_up(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per chunk its distances from each state before it to each behind it, and what its neighbours need."""
    for (k, chunk), rows in _groups(batches, ["k", "chunk"], _ROW):
        layers, gone, _, illegal, ends = layered(rows)
        between = []
        for q in range(4):
            between += distances(layers, [0 if q == e else FAR for e in range(4)])[:4]
        yield pd.DataFrame([(k, chunk, between, sum(gone), illegal, ends[0], ends[1])], columns=["k", "chunk", "between", "gone", "illegal", "first", "last"])


def _join_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per chunk the distances to the end behind it, from the last chunk back; cost and illegal neighbours on the first."""
    pdf = pdf.sort_values("chunk")
    exits, behind = list(ENDS), []
    for between in reversed(list(pdf["between"])):
        behind.append(exits)
        exits = [min(FAR, *(between[4 * e + q] + exits[e] for e in range(4))) for q in range(4)]
    seams = sum(a + b not in ("su", "ua", "au") for a, b in zip(pdf["last"][:-1], pdf["first"][1:]))
    cost = exits[START] + DELETE * int(pdf["gone"].sum())
    return pd.DataFrame({"k": pdf["k"], "chunk": pdf["chunk"], "exits": behind[::-1], "illegal": int(pdf["illegal"].sum()) + seams, "cost": cost})


def _with_exits(batches: Iterable[pd.DataFrame]):
    for (k, chunk), rows in _groups(batches, ["k", "chunk"], [*_ROW, "exits"]):
        rows = list(rows)
        layers, gone, said, _, _ = layered(r[:5] for r in rows)
        yield k, chunk, layers, gone, said, distances(layers, rows[0][5]), rows[0]


def _walk_chunks(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per chunk the state in which a walk from each state leaves it; -1 where none leads to the end."""
    for k, chunk, layers, gone, _, far, _ in _with_exits(batches):
        after = []
        for q in range(4):
            state = q
            for _, _, state in walk(layers, gone, far, q):
                pass
            after.append(state)
        yield pd.DataFrame([(k, chunk, after)], columns=["k", "chunk", "after"])


def _entries(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per chunk the state in which the walk from the start enters it."""
    pdf, state, entries = pdf.sort_values("chunk"), START, []
    for after in pdf["after"]:
        entries.append(state)
        state = after[state]
    last = [False] * (len(entries) - 1) + [True]
    return pd.DataFrame({"k": pdf["k"], "chunk": pdf["chunk"], "entry": entries, "final": last})


def _finish(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audit and digest of conversations whose chunks come in order; one chunk is held at a time."""

    def chunks():
        for (k, _), rows in _groups(batches, ["k", "chunk"], [*_ROW, "exits", "entry", "final", "illegal", "cost"]):
            yield k, list(rows)

    for k, own in itertools.groupby(chunks(), lambda c: c[0]):
        audit, digest = [], Digest()
        for _, rows in own:
            _, _, _, _, _, exits, entry, final, illegal, cost = rows[0]
            layers, gone, said, _, _ = layered(r[:5] for r in rows)
            steps = list(walk(layers, gone, distances(layers, exits), entry))
            if final:
                steps += ending(steps[-1][2] if steps else entry)
            for letter, line in lines(steps, said):
                audit.append(letter)
                if line is not None:
                    digest.add(line)
        yield pd.DataFrame([(k, illegal, cost, "".join(audit), digest.sha.hexdigest())], columns=_SOLVED_NAMES)


def _solve_chunked(rows: DataFrame, order: list, chunks: int) -> DataFrame:
    placed = written(rows.repartitionByRange(chunks, "k", *order).withColumn("chunk", F.spark_partition_id()))
    at = ["k", "chunk"]

    def in_order(df: DataFrame, by: list[str]) -> DataFrame:
        return df.repartition(chunks, *by).sortWithinPartitions(*at, *order).drop("turn", "sha")

    sums = in_order(placed.withColumn("text", F.lit("")), at).mapInPandas(_sum_up, "k string, chunk int, between array<long>, gone long, illegal long, first string, last string")
    behind = written(sums.groupBy("k").applyInPandas(_join_sums, "k string, chunk int, exits array<long>, illegal long, cost long"))
    known = in_order(placed.withColumn("text", F.lit("")).join(behind, at), at)
    entries = written(known.mapInPandas(_walk_chunks, "k string, chunk int, after array<int>").groupBy("k").applyInPandas(_entries, "k string, chunk int, entry int, final boolean"))
    return in_order(placed.join(behind, at).join(entries, at), ["k"]).mapInPandas(_finish, _SOLVED)


# The damage of the registered query: fates of rows by a checksum of their place.
DROPPED, EMPTIED, UNSTOPPED, REPEATED, USURPED, FATES = 0, 1, 2, 3, 4, 20


def damaged(df: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times`` of conversations (nulls of role and text: one blank), damaged by crc32(``conv_id:turn``)."""
    blank = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = df.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(F.encode(place, "UTF-8")) % FATES).alias("fate"))
    text = F.when(F.col("fate") == EMPTIED, "").when(F.col("fate") == UNSTOPPED, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == USURPED, "user").otherwise(F.col("role"))
    times = F.when(F.col("fate") == REPEATED, 2).otherwise(1)
    return rows.where(F.col("fate") != DROPPED).select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))


def repair(rows: DataFrame, whole_rows: int = WHOLE_ROWS, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each conversation of rows.

    rows: ``conv_id, turn, role, text, times``, a row standing for so many equal ones. They are in order of turn (nulls first), then
    role and text, which only tells rows of one turn apart. A row's first fault counts: blank, duplicate (its role and text
    occurred before in the conversation), truncated (its last character that isn't white space is none of .!?). A null conv_id is a conversation
    like any other; other columns have no part. Equal rows become one before any exchange, and a group of any size is spread.
    """
    k = F.coalesce(F.concat(F.lit("k"), F.col("conv_id").cast("string")), F.lit("null"))
    bare = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    runs = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").cast("long").alias("times")).select(k.alias("k"), "*", F.sha2("text", 256).alias("sha"))
    runs = written(runs.withColumns({"empty": bare == "", "open": ~F.right(bare, F.lit(1)).isin(".", "!", "?")}))
    first = runs.groupBy("k", "role", "sha").agg(F.count(F.lit(1)).alias("turns"), F.min(F.struct("turn")).alias("first")).where("turns > 1").drop("turns")
    seen = F.col("first").isNotNull() & ~F.struct("turn").eqNullSafe(F.col("first"))
    rest = F.col("times") - F.when(seen, 0).otherwise(1)  # of equal rows, those that repeat one
    judged = runs.join(first, ["k", "role", "sha"], "left").withColumns({"must": F.col("empty") | seen, "truncated": ~F.col("empty") & ~seen & F.col("open")})
    judged = written(judged.withColumns({"blank": F.when(F.col("empty"), F.col("times")).otherwise(0), "duplicate": F.when(F.col("empty"), 0).when(seen, F.col("times")).otherwise(rest)}).drop("first", "empty", "open"))

    sums = [F.sum(c).alias(c) for c in ("rows", "bytes", "blank", "duplicate", "truncated")]
    by_turn = judged.select("conv_id", "k", "turn", F.lit(1).alias("rows"), F.octet_length("text").alias("bytes"), "blank", "duplicate", F.col("truncated").cast("int").alias("truncated")).groupBy("conv_id", "k", "turn").agg(*sums)
    counts = written(by_turn.groupBy("conv_id", "k").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"), *sums))
    large = counts.where((F.col("rows") > whole_rows) | (F.col("bytes") > whole_bytes))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("sha")]
    kept = judged.select("k", "turn", "role", "text", "sha", "times", "must", "truncated")
    n, size = large.agg(F.sum("rows"), F.sum("bytes")).first()
    whole = kept if n is None else kept.join(large.select("k"), "k", "left_anti")
    solved = whole.repartition("k").sortWithinPartitions("k", *order).select("k", *_ROW).mapInPandas(_solve_whole, _SOLVED)
    if n is not None:
        chunks = int(max(2, n // max(1, whole_rows // 2), size // max(1, whole_bytes // 2)))
        solved = solved.unionByName(_solve_chunked(kept.join(large.select("k"), "k", "left_semi"), order, chunks))
    return counts.select("conv_id", "k", "gaps", "blank", "duplicate", "truncated").join(solved, "k", "left").drop("k")


#: A conversation without a row.
_NOTHING = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}


def repair_damaged(df: DataFrame, **sizes: int) -> DataFrame:
    """:func:`repair` of :func:`damaged` rows, with every conversation of df, even one that lost all its rows: zeros and no audit."""
    done = repair(damaged(df), **sizes).withColumnRenamed("conv_id", "_conv")
    named = df.select("conv_id").distinct().join(done, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    counts = [F.coalesce(c, F.lit(v)).cast("long").alias(c) for c, v in _NOTHING.items()]
    nothing = hashlib.sha256().hexdigest()
    return named.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
