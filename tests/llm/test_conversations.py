"""Conversation repair against all edits of short conversations, and against a search row by row of longer ones."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from apsis.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string, k string, times string, audit string"
ROLE_OF = {"u": "user", "a": "assistant"}


def damage(rows):
    """(conv_id, turn, role, text) after damage; nulls of role and text are one blank."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def faults(rows):
    """Per (turn, role, text) in order: its first fault or None."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def all_edits(rows, found):
    """Cheapest and ASCII-least of every choice of edits, with two inserts at most at each place."""
    inserts = [x for n in range(3) for x in itertools.product([("I", "u", "user:", 3), ("I", "a", "assistant:", 3)], repeat=n)]
    choices = []
    for (_, role, text), fault in zip(rows, found):
        more = 3 if fault == "truncated" else 0
        own = [("D", "", None, 4)]
        if fault not in ("blank", "duplicate"):
            own += [("K", role[:1], f"{role}:{text}", more), *[("R", i, f"{ROLE_OF[i]}:{text}", 3 + more) for i in "ua"]]
        choices += [inserts, [(x,) for x in own]]
    choices.append(inserts)
    best = None
    for parts in itertools.product(*choices):
        steps = [s for p in parts for s in p]
        if re.fullmatch("(s?(ua)+)?", "".join(s[1] for s in steps)):
            way = sum(s[3] for s in steps), "".join(s[0] for s in steps), [s[2] for s in steps if s[2] is not None]
            best = way if best is None or way < best else best
    return best


def searched(rows, found):
    """The same from the last row back, each row an arc of its own, deleted ones too."""
    next_of = {"": "u", "s": "u", "u": "a", "a": "u"}
    kept = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, state, inserts=2):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts:
            c, a, t = best(i, next_of[state], inserts - 1)
            ways.append((c + 3, "I" + a, (ROLE_OF[next_of[state]] + ":", *t)))
        if i < len(rows):
            (_, role, text), fault = rows[i], found[i]
            c, a, t = best(i + 1, state)
            ways.append((c + 4, "D" + a, t))
            more = 3 if fault == "truncated" else 0
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[:1] in kept[state]:
                    c, a, t = best(i + 1, role[:1])
                    ways.append((c + more, "K" + a, (f"{role}:{text}", *t)))
                c, a, t = best(i + 1, next_of[state])
                ways.append((c + 3 + more, "R" + a, (f"{ROLE_OF[next_of[state]]}:{text}", *t)))
        return min(ways, default=(10**9, "", ()))

    for i in range(len(rows), -1, -1):
        for s in next_of:
            best(i, s)
    return best(0, "")


def brute(rows, search=searched):
    convs = {}
    for conv, *_ in rows:
        convs[conv] = []
    for conv, turn, role, text in damage(rows):
        convs[conv].append((turn, role, text))
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        found, turns = faults(own), {t for t, *_ in own if t is not None}
        cost, audit, lines = search(own, found)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(df, **sizes):
    rows = conversations.repair_damaged(df, **sizes).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def test_walk_against_all_edits():
    """Every conversation of two rows, and some of three, by its own faults: the kernel against all choices of edits."""
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("", "x", "x.")]
    cases = [*itertools.product(kinds, repeat=0), *itertools.product(kinds, repeat=1), *itertools.product(kinds, repeat=2)]
    for case in cases:
        rows = [(i, r, t) for i, (r, t) in enumerate(case)]
        found = faults(rows)
        want = all_edits(rows, found)
        assert searched(rows, found) == (want[0], want[1], tuple(want[2])), case
        layers, gone, said, _, _ = conversations.layered((r, t, 1, f in ("blank", "duplicate"), f == "truncated") for (_, r, t), f in zip(rows, found))
        far = conversations.distances(layers)
        steps = list(conversations.walk(layers, gone, far, conversations.START))
        steps += conversations.ending(steps[-1][2] if steps else conversations.START)
        got = list(conversations.lines(steps, said))
        assert ("".join(a for a, _ in got), [line for _, line in got if line is not None]) == (want[1], want[2]), case
        assert far[conversations.START] + 4 * sum(gone) == want[0]


def generated():
    rng = random.Random(11)
    rows = []
    for conv in range(60):
        n = rng.choice([1, 2, 3, 5, 8, 30])
        for i in range(n):
            turn = rng.choice([None, i, i, i, i, i + 3])
            text = rng.choice(["Yes.", "Thanks!", "", " \t", "why", "a.b", "Really?\n", f"line {conv} {i}.", f"line {i}", None])
            rows.append((conv if conv != 7 else None, turn, rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "umpire"]), text))
    return rows + [(None, None, None, None), (500, None, None, None), (501, 2, "user", "Hi."), (501, 2, "user", "Hi.")]


@pytest.mark.parametrize("sizes", [{}, {"whole_rows": 12}, {"whole_bytes": 400}])
def test_repair_against_search(spark, sizes):
    """Whole, and cut into chunks of a few rows: the same results."""
    rows = generated()
    want = brute(rows)
    assert max(len(w[6]) for w in want.values()) > 25 and {"D", "I", "K", "R"} <= set("".join(w[6] for w in want.values()))
    assert repaired(frame(spark, rows), **sizes) == want


def test_giant_conversation(spark):
    """A third of the rows are one conversation, and most of its rows say the same; cut and whole give the same rows."""
    rng = random.Random(3)
    giant = [(1, i, rng.choice(["user", "assistant"]), rng.choice(["Thanks."] * 6 + [f"line {i}.", f"line {i}", ""])) for i in range(2000)]
    rows = giant + [(c, i, "user" if i % 2 == 0 else "assistant", f"text {c} {i}.") for c in range(2, 502) for i in range(8)]
    df = frame(spark, rows)
    cut = repaired(df, whole_rows=300)
    assert cut == repaired(df)
    assert cut[1] == brute(giant)[1]


def test_all_rows_lost_and_no_rows(spark):
    """A conversation whose only row is dropped is still returned; no rows give no rows."""
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert repaired(frame(spark, [(conv, 0, "user", "Hi.")])) == {conv: (0, 0, 0, 0, 0, 0, "", nothing)}
    assert repaired(frame(spark, [])) == {}


def test_long_text(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "end."), (1, 1, "assistant", "x" * 2_000_000)]
    assert repaired(frame(spark, rows)) == brute(rows) == repaired(frame(spark, rows), whole_bytes=2_000_000)


def test_query(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in queries.op11_conversation_repair(spark, sf).collect()}
    assert got == brute(rows)
