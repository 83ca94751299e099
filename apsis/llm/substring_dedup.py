"""Removal of passages that occur more than once: a count-min prefilter, then exact grouping of what it lets through.

A window is a run of consecutive words; a word goes if some window over it also starts elsewhere in the corpus.

1. Rows are dealt evenly into batches by a hash of their content and place. Each batch hashes its windows and adds them to its own
   count-min sketch, kept sparse and cut into ranges of cells: one row per batch, sketch row and range.
2. The partition sketches of a range are added up; each batch gets back, for the cells it touched, whether the merged
   count exceeds one. Counts only overestimate, so no repeated window is lost, and the width follows the data's size.
3. Batches send the windows estimated repeated (128 bits of hash each); equal ones are counted exactly.
4. Batches get the exact verdicts and drop the covered words.

The sketch is never in one place: every range of cells is merged by its own task, whatever the corpus size. A window
repeated a million times weighs one entry per batch. Rows of (batch, range) grow with the product of both numbers until each
holds a few windows, never beyond the number of windows; larger ``batch_bytes`` and ``shard_windows`` keep them down.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, text_bytes, without

WINDOW = 35
BATCH_BYTES, BATCH_ROWS = 6_000_000, 4_000
SHARD_WINDOWS = 4_000_000
#: Rows of the sketch, and cells in each for every window of the corpus.
DEPTH, CELLS_PER_WINDOW = 2, 4
#: Bytes of text that hold at least one word, on average; only sizes depend on it.
BYTES_PER_WORD = 6

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(29), np.uint64(32))


def _join_hashes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring runs from theirs."""
    z = x * _MIX[0]
    z += y
    z ^= z >> _MIX[2]
    z *= _MIX[1]
    z ^= z >> _MIX[3]
    return z


def _runs(h: np.ndarray, window: int) -> np.ndarray:
    """Hash of each run of ``window`` values, by doubling."""
    n = len(h) - window + 1
    out, at, blocks = None, 0, [h]
    while 2 ** len(blocks) <= window:
        b, half = blocks[-1], 2 ** (len(blocks) - 1)
        blocks.append(_join_hashes(b[: len(b) - half], b[half:]))
    for k in range(len(blocks) - 1, -1, -1):
        if window >> k & 1:
            part = blocks[k][at : at + n]
            out = part if out is None else _join_hashes(out, part)
            at += 2**k
    return out


def split_words(text: str | None) -> list[bytes]:
    """Words of a text; bytes.split() separates at blank and 0x09 to 0x0D, no more."""
    return text.encode().split() if text else []


class _Batch:
    """Windows of a batch of texts: two hash lanes, and the word at which each starts."""

    def __init__(self, texts, window: int):
        digest = xxhash.xxh3_128_digest
        lens, parts = [], []
        for text in texts:
            ws = split_words(text)
            lens.append(len(ws))
            parts.append(b"".join(map(digest, ws)))
        self.lens = np.array(lens, np.int64)
        words = np.frombuffer(b"".join(parts), "<u8").reshape(-1, 2)
        del parts
        if len(words) < window:
            self.starts, self.a, self.b = np.empty(0, np.int64), *np.empty((2, 0), np.uint64)
            return
        doc = np.repeat(np.arange(len(lens)), self.lens)
        self.starts = np.flatnonzero(doc[: len(doc) - window + 1] == doc[window - 1 :])
        self.a, self.b = (_runs(np.ascontiguousarray(words[:, i]), window)[self.starts] for i in (0, 1))

    def cells(self, row: int, bits: int) -> np.ndarray:
        """Cell of each window in one row of the sketch."""
        lane = self.a if row == 0 else _join_hashes(self.b, np.full_like(self.b, row))
        return lane >> np.uint64(64 - bits)


def _counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and which occur more than once."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return x[first], np.diff(np.append(first, len(x))) > 1


def _planes(x: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as planes of bytes, so that their zero high bytes compress away."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def _bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def _mask(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)


_SLICE = "kind int, shard int, _batch int, digest long, values binary, more binary, twice binary"
_VERDICT = "kind int, shard int, _batch int, digest long, verdict binary"


def _slices(kind: int, values: np.ndarray, more: np.ndarray | None, twice: np.ndarray, shards: int, bits: int):
    """Cut sorted values at the shards' borders; of plain values, the gaps are sent."""
    borders = _borders(values, shards, bits)
    for s in range(shards):
        p, q = borders[s], borders[s + 1]
        if p < q:
            v = values[p:q]
            yield kind, s, _planes(np.diff(v, prepend=np.uint64(0))), b"" if more is None else more[p:q].tobytes(), _bits(twice[p:q])


def _borders(values: np.ndarray, shards: int, bits: int) -> np.ndarray:
    """Where each shard's range of sorted values begins, and their end."""
    step = (1 << bits) // shards + 1
    starts = np.array([s * step for s in range(shards)], np.uint64)
    return np.append(np.searchsorted(values, starts), len(values))


def _slice_frame(rows, batch: int, digest: int) -> pd.DataFrame:
    return pd.DataFrame([(k, s, batch, digest, v, m, t) for k, s, v, m, t in rows], columns=["kind", "shard", "_batch", "digest", "values", "more", "twice"])


def _digest(texts, found: pd.DataFrame | None = None) -> int:
    """What the texts of a batch are, in any order; verdicts on others raise an error."""
    total = sum(xxhash.xxh64_intdigest(t) for t in texts if t) + len(texts)
    own = total % (1 << 64) - (1 << 63)
    if found is not None and (found["digest"] != own).any():
        raise RuntimeError("rows came in another order when they were read again; write the table first")
    return own


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Add up the batches' slices of one shard: for each batch, which of its values occur more than once in all."""
    kind, shard = int(pdf["kind"].iloc[0]), int(pdf["shard"].iloc[0])
    values = [np.cumsum(_numbers(v), dtype=np.uint64) for v in pdf["values"]]
    lens = [len(v) for v in values]
    weight = np.concatenate([_mask(t, n) for t, n in zip(pdf["twice"], lens)]).astype(np.int8) + 1
    flat = np.concatenate(values)
    del values
    order = np.argsort(flat, kind="stable")
    if kind < 0:  # exact: a second lane decides between equal first ones
        second = np.concatenate([np.frombuffer(m, "<u8") for m in pdf["more"]])
        order = np.lexsort((second, flat))
    new = np.ones(len(flat), bool)
    ordered = flat[order]
    new[1:] = ordered[1:] != ordered[:-1]
    if kind < 0:
        ordered = second[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    total = np.add.reduceat(weight[order], np.flatnonzero(new), dtype=np.int64)
    often = np.empty(len(flat), bool)
    often[order] = (total > 1)[np.cumsum(new) - 1]
    cuts = np.split(often, np.cumsum(lens)[:-1])
    return pd.DataFrame({"kind": kind, "shard": shard, "_batch": pdf["_batch"], "digest": pdf["digest"], "verdict": [_bits(c) for c in cuts]})


class Plan:
    """Sizes that follow from the text's bytes."""

    def __init__(self, rows: int, size: int, window: int, batch_bytes: int, shard_windows: int):
        n = max(1, size // BYTES_PER_WORD)
        self.window, self.shards = window, max(1, -(-n // shard_windows))
        self.batches = max(1, -(-size // batch_bytes), -(-rows // BATCH_ROWS))
        self.bits = max(10, int(CELLS_PER_WINDOW * n).bit_length())

    def sketch(self, texts):
        b = _Batch(texts, self.window)
        for row in range(DEPTH):
            cells, twice = _counted(b.cells(row, self.bits))
            yield from _slices(row, cells, None, twice, self.shards, self.bits)

    def verdicts(self, found: pd.DataFrame, kind: int, values: np.ndarray, bits: int) -> np.ndarray:
        """The shards' verdicts on a batch's sorted values."""
        borders = _borders(values, self.shards, bits)
        out = np.zeros(len(values), bool)
        for shard, verdict in found.loc[found["kind"] == kind, ["shard", "verdict"]].itertuples(index=False):
            p, q = borders[shard], borders[shard + 1]
            out[p:q] = _mask(verdict, q - p)
        return out

    def candidates(self, b: _Batch, found: pd.DataFrame):
        """Windows that the merged sketch estimates repeated, sorted by both lanes: their places, lanes, and which are new."""
        live = np.ones(len(b.a), bool)
        for row in range(DEPTH):
            own = b.cells(row, self.bits)
            order = np.argsort(own)
            own = own[order]
            new = np.ones(len(own), bool)
            new[1:] = own[1:] != own[:-1]
            live[order] &= self.verdicts(found, row, own[new], self.bits)[np.cumsum(new) - 1]
        at = np.flatnonzero(live)
        at = at[np.lexsort((b.b[at], b.a[at]))]
        x, y = b.a[at], b.b[at]
        new = np.ones(len(at), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        return at, x, y, new

    def exact(self, texts, found: pd.DataFrame):
        at, x, y, new = self.candidates(_Batch(texts, self.window), found)
        first = np.flatnonzero(new)
        twice = np.diff(np.append(first, len(at))) > 1
        yield from _slices(-1, x[first], y[first], twice, self.shards, 64)

    def repeated(self, texts, found: pd.DataFrame) -> list[np.ndarray]:
        """For each text, which of its words are covered by a repeated window."""
        b = _Batch(texts, self.window)
        at, x, _, new = self.candidates(b, found)
        often = self.verdicts(found, -1, x[new], 64)
        starts = b.starts[at[often[np.cumsum(new) - 1]]]
        change = np.zeros(int(b.lens.sum()) + 1, np.int32)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + self.window, -1)
        return np.split(np.cumsum(change)[:-1] > 0, np.cumsum(b.lens)[:-1])


def remove_repeats(
    df: DataFrame, text: str = "text", window: int = WINDOW, n_words: str = "n_words", n_removed: str = "n_removed",
    batch_bytes: int = BATCH_BYTES, shard_windows: int = SHARD_WINDOWS,
) -> DataFrame:
    """df with the text reduced to the words that no repeated window covers, joined by one blank, and both word counts.

    Windows are judged on the input. Texts shorter than a window, empty and null ones have none (null becomes empty).
    Repeated rows are repeats of each other and lose all their windows. An input column named like a result is replaced;
    an empty table gives an empty table. df is read three times and dealt by content and place; a plan whose rows come in
    another order when read again raises an error; write it first.
    """
    kept = without(df, n_words, n_removed)
    rows, size = text_bytes(df, text)
    plan = Plan(rows, size, window, batch_bytes, shard_windows)
    hashable = [F.col(f"`{f.name}`") for f in kept.schema if isinstance(f.dataType, T.AtomicType)]
    docs = kept.withColumn("_batch", F.pmod(F.xxhash64(F.monotonically_increasing_id(), *hashable), F.lit(plan.batches)).cast("int"))

    def sketch(key, pdf):
        return give_back(_slice_frame(plan.sketch(pdf[text]), int(key[0]), _digest(pdf[text])))

    def exact(key, pdf, found):
        return give_back(_slice_frame(plan.exact(pdf[text], found), int(key[0]), _digest(pdf[text], found)))

    def finish(pdf, found):
        texts = pdf[text]
        _digest(texts, found)
        gone = plan.repeated(texts, found) if len(pdf) else []
        out = pdf.drop(columns="_batch")
        out[text] = [b" ".join([w for w, g in zip(split_words(t), m) if not g] if m.any() else split_words(t)).decode() for t, m in zip(texts, gone)]
        out[n_words], out[n_removed] = [len(m) for m in gone], [int(m.sum()) for m in gone]
        return give_back(out)

    def merged(slices):
        return slices.groupBy("kind", "shard").applyInPandas(lambda pdf: give_back(_merge(pdf)), _VERDICT)

    by_batch = docs.groupBy("_batch")
    estimates = merged(by_batch.applyInPandas(sketch, _SLICE))
    verdicts = merged(by_batch.cogroup(estimates.groupBy("_batch")).applyInPandas(exact, _SLICE))
    schema = T.StructType([*kept.schema.fields, T.StructField(n_words, T.LongType()), T.StructField(n_removed, T.LongType())])
    return by_batch.cogroup(estimates.unionByName(verdicts).groupBy("_batch")).applyInPandas(finish, schema)
