"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by a bit-sliced Hamming comparison.

Equal fingerprints are one class from the start. Classes within the radius agree on at least one of the combinations of
blocks that the pigeonhole principle allows, so each combination deals them into buckets and no link is lost. Inside a
bucket the fingerprints lie as 64 vertical bit planes; one pass of carry-save adders counts the differing bits of 64
pairs per machine word, and words in which every pair is beyond the radius are given up early. A bucket over
``CHUNK`` classes is cut into chunks whose pairs are compared separately; a bucket yields a forest, never all its pairs.

Where a least Jaccard similarity is asked for, no radius on 64 bits would hold it, and the pigeonhole's combinations would
grow with the table. Classes then meet in buckets of equal minima of their shingles' hashes (BANDS of ROWS each, at any
size), only those that meet another fetch their fingerprints, and the bit-sliced comparison runs over four fingerprints.
Its links are candidates: the shingles of each component of them are compared exactly, and only true links enter the result.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, join_hot, without, written
from .components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Classes that a bucket should hold, and those beyond which it is cut.
BUCKET, CHUNK = 2048, 8192
#: Buckets of a class by its shingles' minima, and minima that make one: 0.999 of pairs at a Jaccard similarity of 0.8 meet.
BANDS, ROWS = 13, 4
#: Classes of a bucket up to which many buckets are compared at once, and the rows of such a batch.
SMALL, BATCH_ROWS = 64, 4_000
#: Shingles of a component's classes beyond which it is cut for the exact comparison.
CHUNK_SHINGLES = 1 << 20
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _hashes(text: str | None, shingle: int) -> np.ndarray:
    """Hashes of a text's shingles in order; a text of fewer words is one shingle, without words it has none."""
    ws = text.encode().lower().split() if text else []  # bytes.lower() folds A-Z alone
    if not ws:
        return np.empty(0, np.uint64)
    count = max(1, len(ws) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in ws])
    line = b" ".join(ws)
    first = [0, *ends[: count - 1].tolist()]
    last = (ends[len(ws) - count :] - 1).tolist()
    xx = xxhash.xxh64_intdigest
    return np.fromiter((xx(line[p:q], SEED) for p, q in zip(first, last)), np.uint64, count)


def _bits(h: np.ndarray, n: int) -> tuple[int, ...]:
    """n fingerprints of hashes; the first is plain SimHash, the others mix each hash with their number."""
    count, out = len(h), []
    if not count:
        return (0,) * n
    for i in range(n):
        if i:
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * i)
            h ^= h >> np.uint64(29)
        ones = np.zeros(64, np.int64)
        for part in range(0, count, 4096):
            ones += np.unpackbits(h[part : part + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True))
    return tuple(out)


def _fingerprints(text: str | None, shingle: int, n: int) -> tuple[int, ...]:
    """n fingerprints of a text."""
    return _bits(_hashes(text, shingle), n)


_ODD = (np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


def _bands(h: np.ndarray) -> list[int]:
    """One key for each band: a mix of the smallest of the hashes under each of its permutations."""
    least = np.full(len(_ODD), _FULL)
    for part in range(0, len(h), 2048):
        least = np.minimum(least, (h[part : part + 2048] * _ODD[:, None]).min(axis=1))
    rows = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(r.tobytes()) - (1 << 63) for r in rows]


def _set_fingerprints(text: str | None, shingle: int, n: int) -> tuple:
    """n fingerprints of a text's distinct shingles, as Jaccard similarity counts them, a hash of their set, and its band keys."""
    h = np.unique(_hashes(text, shingle))
    return *_bits(h, n), int.from_bytes(xxhash.xxh64_digest(h.tobytes(), SEED), "big", signed=True), _bands(h) if len(h) else []


def _marking(df: DataFrame, text: str, shingle: int, made_of, fps: tuple[str, ...], more: list[T.StructField]) -> DataFrame:
    """df with what made_of gives for its text, in columns of the fingerprints' names and more."""
    names = (*fps, *[f.name for f in more])
    kept = without(df, *names)
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, T.LongType()) for n in fps], *more])
    kinds = [pa.list_(pa.int64()) if isinstance(schema[n].dataType, T.ArrayType) else pa.int64() for n in names]

    def run(batches):
        for batch in batches:
            made = [made_of(t.as_py(), shingle, len(fps)) for t in batch.column(batch.schema.names.index(text))]
            columns = zip(*made) if made else [()] * len(names)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=[*batch.schema.names, *names])
        batch = made = columns = None
        give_back()

    return kept.mapInArrow(run, schema)


def fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE, names: tuple[str, ...] = ("fp",)) -> DataFrame:
    """df with one 64-bit fingerprint (long) per name. A text of fewer words is one shingle; without words it is zero."""
    return _marking(df, text, shingle, _fingerprints, names, [])


def set_fingerprints(df: DataFrame, text: str, shingle: int, names: tuple[str, ...], set_hash: str, bands: str) -> DataFrame:
    """df with fingerprints of the distinct shingles, the hash of their set, and the keys of its bands (none without words)."""
    return _marking(df, text, shingle, _set_fingerprints, names, [T.StructField(set_hash, T.LongType()), T.StructField(bands, T.ArrayType(T.LongType()))])


def block_plan(n: int, radius: int, bucket: int | None = None) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """Blocks of the 64 bits as (first bit, bits) and the combinations that must agree, for n classes.

    With radius + r blocks at least r agree. r is the least whose combined bits bring buckets down to ``bucket`` (BUCKET).
    """
    wanted = max(0, math.ceil(math.log2(max(1, n) / (bucket or BUCKET))))
    for r in range(1, 6):
        blocks = radius + r
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        sizes = [q - p for p, q in itertools.pairwise(cuts)]
        if r * min(sizes) >= wanted or r == 5:
            use = min(min(sizes), math.ceil(wanted / r))
            return [(p, use) for p in cuts[:-1]], list(itertools.combinations(range(blocks), r))
    raise AssertionError


def _planes(x: np.ndarray) -> np.ndarray:
    """Bit planes of fingerprints: row b holds bit b of all, 64 to a word."""
    padded = np.zeros(-(-len(x) // 64) * 64, np.uint64)
    padded[: len(x)] = x
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count exceeds the radius."""
    more, same = over.copy(), ~over
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            same &= counters[k]
        else:
            more |= same & counters[k]
            same &= ~counters[k]
    return more


def close_pairs(x: np.ndarray, y: np.ndarray, radius: int, pairs: int = 262_144):
    """Pairs (i, j) of x and y at most radius bits apart, in blocks of rows of x that make about so many pairs at most."""
    rows = max(1, pairs // max(1, len(y)))
    planes, width = _planes(y), -(-len(y) // 64)
    valid = np.packbits(np.arange(width * 64) < len(y), bitorder="little").view("<u8")
    levels = radius.bit_length()
    for start in range(0, len(x), rows):
        q = x[start : start + rows]
        flip = ((q[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)) * _FULL
        at_q, at_w = (a.reshape(-1) for a in np.indices((len(q), width)))
        counters = [np.zeros(len(at_q), np.uint64) for _ in range(levels)]
        over, whole = np.zeros(len(at_q), np.uint64), True
        for b in range(0, 64, 2):
            if whole:
                u, v = ((planes[k][None, :] ^ flip[:, k][:, None]).reshape(-1) for k in (b, b + 1))
            else:
                u, v = (planes[k][at_w] ^ flip[at_q, k] for k in (b, b + 1))
            either = u ^ v
            carry = (u & v) | (counters[0] & either)  # full adder: two planes and the lowest counter
            counters[0] ^= either
            for k in range(1, levels):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
            if b >= 3 * radius + 8 and b % 8 == 6 or b == 62:
                live = ~_beyond(counters, over, radius) & valid[at_w]
                keep = np.flatnonzero(live)
                at_q, at_w, over, counters = at_q[keep], at_w[keep], over[keep], [c[keep] for c in counters]
                whole = False
                if not len(keep):
                    break
        if len(at_q):
            lanes = np.unpackbits(live[keep].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, lane = np.nonzero(lanes)
            yield start + at_q[word], at_w[word] * 64 + lane


def within(x: np.ndarray, y: np.ndarray, most: int, lanes: int = 65_536) -> np.ndarray:
    """Which pairs of rows (each of several 64-bit words) differ in at most so many bits: bit planes of many pairs at once."""
    out = np.zeros(len(x), bool)
    levels = most.bit_length()
    for start in range(0, len(x), lanes):
        apart = x[start : start + lanes] ^ y[start : start + lanes]
        width = -(-len(apart) // 64)
        at = np.arange(width)
        counters, over = [np.zeros(width, np.uint64) for _ in range(levels)], np.zeros(width, np.uint64)
        for k in range(apart.shape[1]):
            planes = _planes(apart[:, k])[:, at]
            for b in range(0, 64, 2):
                u, v = planes[b], planes[b + 1]
                either = u ^ v
                carry = (u & v) | (counters[0] & either)
                counters[0] = counters[0] ^ either
                for j in range(1, levels):
                    counters[j], carry = counters[j] ^ carry, counters[j] & carry
                over = over | carry
            live = ~_beyond(counters, over, most)
            keep = np.flatnonzero(live)
            at, over, counters = at[keep], over[keep], [c[keep] for c in counters]
            if not len(at):
                break
        if len(at):
            bits = np.unpackbits(live[keep].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, lane = np.nonzero(bits)
            found = at[word] * 64 + lane
            out[start + found[found < len(apart)]] = True
    return out


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots after the linked pairs were joined: each the first of its component."""
    while len(i):
        i, j = root[i], root[j]
        i, j = i[i != j], j[i != j]
        np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
        while (root[root] != root).any():
            root = root[root]
    return root


def _links_of(root: np.ndarray, node: np.ndarray) -> pd.DataFrame:
    at = np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"a": node[at], "b": node[root[at]]})


def _words(pdf: pd.DataFrame, columns: list[str]) -> np.ndarray:
    return np.stack([pdf[c].to_numpy(np.int64).view(np.uint64) for c in columns], axis=1)


def _forest(left: pd.DataFrame, right: pd.DataFrame, radius: int, checks: list[str], most: int | None):
    """Links that join what the two sides connect: each class to the first of its component."""
    same = left is right
    both = left if same else pd.concat([left, right])
    words = _words(both, ["fp", *checks])
    fps = words[:, 0]
    x, y = (fps, fps) if same else (fps[: len(left)], fps[len(left) :])
    root = np.arange(len(both))
    for i, j in close_pairs(x, y, radius):
        if same:
            i, j = i[i < j], j[i < j]
        else:
            j = j + len(left)
        if most is not None:
            new = root[i] != root[j]  # what is connected already needs no further look
            i, j = i[new], j[new]
            near = within(words[i], words[j], most)
            i, j = i[near], j[near]
        root = _join(root, i, j)
    return _links_of(root, both["node"].to_numpy())


def _forest_of_many(pdf: pd.DataFrame, fps: list[str], most: int):
    """Links of many small buckets at once: each class is compared with those some places after it in its bucket."""
    pdf = pdf.sort_values(["t", "bucket"])
    words, node = _words(pdf, fps), pdf["node"].to_numpy()
    t, bucket = pdf["t"].to_numpy(), pdf["bucket"].to_numpy()
    root = np.arange(len(pdf))
    for d in range(1, len(pdf)):
        i = np.flatnonzero((t[d:] == t[:-d]) & (bucket[d:] == bucket[:-d]))
        if not len(i):
            break
        i = i[root[i] != root[i + d]]
        i = i[within(words[i], words[i + d], most)]
        root = _join(root, i, i + d)
    return _links_of(root, node)


def links(classes: DataFrame, radius: int = RADIUS, checks: tuple[str, ...] = (), most: int | None = None, bucket: int | None = None) -> DataFrame:
    """Links ``a, b`` between nodes of classes (``node``, distinct, and ``fp``) that connect all within radius.

    With checks, further fingerprints of the same texts, a link needs at most ``most`` differing bits over all of them.
    """
    blocks, combos = block_plan(classes.count(), radius, bucket)
    keys = []
    for t, combo in enumerate(combos):
        bucket = F.lit(0).cast("long")
        for first, bits in (blocks[k] for k in combo):
            bucket = F.shiftleft(bucket, bits).bitwiseOR(F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1).cast("long")))
        keys.append(F.struct(F.lit(t).alias("t"), bucket.alias("bucket")))
    dealt = classes.select("node", "fp", *checks, F.explode(F.array(*keys)).alias("k")).select("node", "fp", *checks, "k.*")
    large = dealt.groupBy("t", "bucket").count().where(F.col("count") > CHUNK).select("t", "bucket", F.ceil(F.col("count") / CHUNK).alias("chunks"))
    return _compared(dealt.join(large, ["t", "bucket"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))), radius, checks, most)


def _compared(dealt: DataFrame, radius: int, checks: tuple[str, ...], most: int | None) -> DataFrame:
    """Links within buckets (``t, bucket``, cut into ``chunks`` whose pairs are compared) of ``node, fp`` and checks."""
    chunked = (
        dealt.withColumn("own", F.pmod(F.xxhash64("node", "t"), "chunks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("node", "fp", *checks, "t", "bucket", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )

    def compare(key, pdf):
        left = pdf[pdf["own"] == key[2]]
        return _forest(left, left if key[2] == key[3] else pdf[pdf["own"] == key[3]], radius, list(checks), most)

    kind = dealt.schema["node"].dataType.simpleString()
    return chunked.groupBy("t", "bucket", "i", "j").applyInPandas(compare, f"a {kind}, b {kind}")


def set_links(classes: DataFrame, fps: tuple[str, ...], bands: str, radius: int, most: int) -> DataFrame:
    """Links ``a, b`` that connect classes (``node``) of one bucket whose fingerprints differ in at most ``most`` bits in all.

    In buckets of over SMALL classes the first fingerprints must be within ``radius`` besides. Every class deals BANDS keys,
    whatever the table's size; fingerprints follow to those that meet another class.
    """
    keyed = classes.select("node", F.posexplode(bands).alias("t", "bucket"))
    sizes = keyed.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumn("_n", F.col("size"))
    met = join_hot(keyed, sizes, ["t", "bucket"], BANDS * classes.count())
    met = written(met.join(classes.select("node", *fps), "node"))
    small, large = met.where(F.col("size") <= SMALL), met.where(F.col("size") > SMALL)
    kind = classes.schema["node"].dataType.simpleString()
    batch = F.pmod(F.xxhash64("t", "bucket"), F.lit(small.count() // BATCH_ROWS + 1))
    found = small.groupBy(batch.alias("batch")).applyInPandas(lambda pdf: _forest_of_many(pdf, list(fps), most), f"a {kind}, b {kind}")
    first, checks = fps[0], fps[1:]
    dealt = large.select("node", F.col(first).alias("fp"), *checks, "t", "bucket", F.ceil(F.col("size") / CHUNK).alias("chunks"))
    return found.union(_compared(dealt, radius, checks, most))


def _similar(sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Members and the first member of their component, for all members but the first, over pairs of at least that Jaccard similarity.

    A member is compared with those that no component has taken yet, so a group of copies costs one comparison each.
    """
    sizes = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    marks = np.zeros(codes.max(initial=-1) + 1, bool)
    ends = np.cumsum(sizes)
    own = [codes[e - n : e] for e, n in zip(ends, sizes)]
    left, flat, stops = np.arange(len(sets)), codes, ends  # members not taken, when last gathered
    free, root = np.ones(len(sets), bool), np.arange(len(sets))
    for seed in range(len(sets)):
        if not free[seed]:
            continue
        free[seed], queue = False, [seed]
        while queue and free.any():
            i = queue.pop()
            if 2 * free.sum() <= len(left):
                left = np.flatnonzero(free)
                flat, stops = np.concatenate([own[k] for k in left]), np.cumsum(sizes[left])
            marks[own[i]] = True
            both = np.diff(np.concatenate([[0], np.cumsum(marks[flat])])[np.concatenate([[0], stops])])
            marks[own[i]] = False
            near = left[free[left] & (both > 0) & (both / np.maximum(sizes[i] + sizes[left] - both, 1) >= least)]
            free[near], root[near] = False, seed
            queue.extend(near.tolist())
    at = np.flatnonzero(root != np.arange(len(sets)))
    return at, root[at]


def verified(members: DataFrame, least: float, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Links ``a, b`` that connect all members (``node``, ``root``, and their text) of one root whose shingles are that similar.

    Small roots are compared many to a task; one with more than CHUNK_SHINGLES is cut into chunks whose pairs are compared.
    """
    kind = members.schema["node"].dataType.simpleString()

    def hashed(batches):
        for b in batches:
            sets = [np.unique(_hashes(t.as_py(), shingle)).view(np.int64) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("root"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "root", "size", "shingles"])
        b = sets = None
        give_back()

    rows = written(members.select("node", "root", F.col(f"`{text}`").alias("text")).mapInArrow(hashed, f"node {kind}, root {kind}, size long, shingles array<long>"))
    chunks = F.greatest(F.ceil(F.sum("size") / CHUNK_SHINGLES), F.lit(1).cast("long"))
    large = written(rows.groupBy("root").agg(chunks.alias("chunks")).where("chunks > 1"))
    batches = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // CHUNK_SHINGLES))
    dealt = rows.join(large, "root", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), "chunks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    # Roots that share a batch are told apart inside it.
    batch = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("root"), F.lit(batches))).otherwise(F.xxhash64("root"))
    dealt = dealt.select("node", "root", "shingles", batch.alias("batch"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(pdf):
        out = [pd.DataFrame({"a": pdf["node"].iloc[:0], "b": pdf["node"].iloc[:0]})]
        nodes, sets = pdf["node"].to_numpy(), pdf["shingles"].to_numpy()
        for at in pdf.groupby("root").indices.values():
            a, b = _similar([np.asarray(sets[k], np.int64) for k in at], least)
            out.append(pd.DataFrame({"a": nodes[at[a]], "b": nodes[at[b]]}))
        return give_back(pd.concat(out))

    return dealt.groupBy("batch", "i", "j").applyInPandas(compare, f"a {kind}, b {kind}")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
    fps: tuple[str, ...] = ("fp",), most: int | None = None, component: str = "component_id", least: float | None = None,
) -> DataFrame:
    """df less its text, with fingerprints and the smallest id reachable over links, its own included.

    With several fingerprints, texts link if any of them is within radius and all together differ in at most ``most`` bits.
    With ``least``, texts link if the Jaccard similarity of their shingles is at least that; candidates share a band and
    differ in at most ``most`` bits. Texts of equal shingles are one class, and ids must be distinct and not null.
    Null ids link like others but are never the smallest; a component of null ids only has a null one. Null and empty
    texts have fingerprint zero and link like any other. Repeated rows stay. Input columns named like a result are
    replaced. An empty table gives an empty table.
    """
    kept = without(df, component)
    if least is None:
        parts, made = list(fps), fingerprints(kept, text, shingle, fps)
        node = F.col(fps[0]) if len(fps) == 1 else F.concat(*[F.lpad(F.hex(f), 16, "0") for f in fps[:2]])
    else:
        parts, made, node = [*fps, "_set"], set_fingerprints(kept, text, shingle, fps, "_set", "_bands"), F.col("_set")
    marked = written(made.drop(text))
    grouped = marked.groupBy(*parts).agg(F.min(id_col).alias("least_id"), F.count(F.lit(1)).alias("_n"), *([F.first("_bands").alias("_bands")] if least is not None else []))
    classes = written(grouped.withColumn("node", node))
    if least is None:
        found = None
        for f in fps:
            checks = tuple(c for c in fps if c != f)
            part = links(classes.select("node", F.col(f).alias("fp"), *checks), radius, checks, most)
            found = part if found is None else found.union(part)
        roots = components(found)
    else:
        roots = components(set_links(classes, fps, "_bands", radius, most))
        members = classes.join(roots, "node").select("node", "root", F.col("least_id").alias(id_col))
        roots = components(verified(df.select(id_col, text).join(members, id_col), least, text, shingle))
    rooted = written(classes.select("node", "least_id", "_n", *parts).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    first = rooted.groupBy("root").agg(F.min("least_id").alias(component), F.count(F.lit(1)).alias("_n"))
    done = join_hot(rooted.withColumnRenamed("_n", "_rows"), first, ["root"], rooted.count()).select(*parts, component, F.col("_rows").alias("_n"))
    names = [c for c in marked.columns if c not in ("_set", "_bands")]
    return join_hot(marked.select(*{c: 0 for c in [*names, *parts]}), done, parts, marked.count()).select(*names, component)
