"""Token counts: pieces are counted once per distinct pre-token and summed over each document's pre-token frequencies.

Documents fall into blocks. For every shard of the pre-tokens a block asks once for its distinct ones (one row per block
and shard); the shuffle by shard brings equal pre-tokens of all blocks together, each distinct one is tokenised once, and
a block gets back one number per pre-token it asked for. The block's own frequencies, one packed row, meet those answers
and give a sum per document. Questions and frequencies come from one pass over the texts and leave it by one shuffle, which
both readers share. No ids are kept. A frequent pre-token weighs one entry per block, so no shard is hot.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary
from .common import text_bytes, without

#: Text characters in a block of documents.
BLOCK_CHARS = 8_000_000
#: Input bytes whose pre-tokens should share a shard.
SHARD_BYTES = 16_000_000
#: What a block sends: a question to each shard (kind 0, key: the shard) and its frequencies (kind 1, key: the block).
QUESTION, FREQUENCIES = 0, 1
SENT = "kind int, key long, block long, pieces array<string>, ids binary, digests binary, spread binary, docs binary, times binary"


class _Block:
    """Documents of a block, its distinct pre-tokens in order of shard and text, and where they occur."""

    def __init__(self, model, ids: list[int], texts: list[str | None], shards: int):
        self.digests = np.array([xxhash.xxh64_intdigest(t, 42) if t is not None else 42 for t in texts], np.uint64).view(np.int64)
        # Of rows and texts: another order of rows in a later pass gives another key, never another block's numbers.
        self.key = xxhash.xxh64_intdigest(np.array(ids, np.int64).tobytes() + self.digests.tobytes()) - (1 << 63)
        number: dict[str, int] = {}
        word, times, per_doc = [], [], []
        for text in texts:
            counts = Counter(model.pre_tokens(text or ""))
            word += [number.setdefault(w, len(number)) for w in counts]
            times += counts.values()
            per_doc.append(len(counts))
        shard = [xxhash.xxh32_intdigest(w) % shards for w in number]
        names = sorted(zip(shard, number))
        place = np.empty(len(names), np.int64)
        place[[number[w] for _, w in names]] = np.arange(len(names))
        self.ids, self.names, self.cuts = ids, [w for _, w in names], np.bincount(shard, minlength=shards) if shard else []
        word = place[np.array(word, np.int64)]
        order = np.argsort(word, kind="stable")
        self.spread = np.bincount(word, minlength=len(names))
        self.times = np.array(times, np.uint32)[order]
        self.docs = np.repeat(np.arange(len(texts)), per_doc)[order]

    def rows(self):
        at = 0
        for s, n in enumerate(self.cuts):
            if n:
                yield QUESTION, s, self.key, self.names[at : at + n], None, None, None, None, None
            at += n
        packed = np.array(self.ids, np.int64).tobytes(), self.digests.tobytes(), _planes(self.spread), _planes(self.docs), _planes(self.times)
        yield FREQUENCIES, self.key, self.key, None, *packed

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame(self.rows(), columns=[f.split()[0] for f in SENT.split(", ")])


def _planes(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as four planes of bytes: the empty high ones compress to nothing."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def count_tokens(df: DataFrame, vocabulary: Vocabulary, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """df's other columns, with ``n_tokens`` instead of the text: the number of tokens of the whole text.

    A null or empty text has none; every row gives one row, repeated rows too; an input column named like the result is
    replaced; an empty table gives an empty table. df is read twice, after its size, and its rows are numbered in reading order. A
    plan whose rows come in another order when read again (by a lost executor, say) raises an error; write it first.
    """
    _, size = text_bytes(df, text)
    shards = max(1, -(-size // SHARD_BYTES))
    numbered = without(df, n_tokens).withColumn("_row", F.monotonically_increasing_id())
    kept = [c for c in numbered.columns if c not in (text, "_row")]

    def send(batches):
        model = vocabulary.model()
        for pdf in batches:
            ids, texts, chars = [], [], 0
            for i, t in zip(pdf["_row"], pdf["_text"]):
                ids.append(i)
                texts.append(t)
                chars += len(t or "")
                if chars >= BLOCK_CHARS:
                    yield _Block(model, ids, texts, shards).frame()
                    ids, texts, chars = [], [], 0
            if ids:
                yield _Block(model, ids, texts, shards).frame()

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["kind"].iloc[0] != QUESTION:
            return pd.DataFrame(columns=["kind", "block", "shard", "counts"])
        counts = _piece_counts(vocabulary.model(), sorted(set().union(*pdf["pieces"])))
        return pd.DataFrame({"kind": FREQUENCIES, "block": pdf["block"], "shard": pdf["key"], "counts": [_planes(np.fromiter((counts[w] for w in ws), np.int64, len(ws))) for ws in pdf["pieces"]]})

    def add(frequencies: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if len(frequencies) and frequencies["kind"].iloc[0] == QUESTION:
            return pd.DataFrame(columns=["_row", "_digest", n_tokens])
        counts = np.concatenate([np.empty(0, np.uint32), *map(_numbers, answers.sort_values("shard")["counts"])])
        if len(frequencies) != 1 or len(counts) != len(frequencies["spread"].iloc[0]) // 4:
            raise RuntimeError("rows came in another order when they were read again; write the table first")
        digests = np.frombuffer(frequencies["digests"].iloc[0], np.int64)
        ids, spread, docs, times = frequencies[["ids", "spread", "docs", "times"]].iloc[0]
        ids = np.frombuffer(ids, np.int64)
        total = np.bincount(_numbers(docs), np.repeat(counts, _numbers(spread)) * _numbers(times).astype(np.float64), minlength=len(ids))
        return pd.DataFrame({"_row": ids, "_digest": digests, n_tokens: total.astype(np.int64)})

    texts = numbered.select("_row", F.col(f"`{text}`").alias("_text"))
    sent = texts.mapInPandas(send, SENT).groupBy("kind", "key")
    answers = sent.applyInPandas(answer, "kind int, block long, shard long, counts binary")
    totals = sent.cogroup(answers.groupBy("kind", "block")).applyInPandas(add, f"_row long, _digest long, `{n_tokens}` long")
    rest = numbered.select("_row", F.xxhash64(F.col(f"`{text}`")).alias("_own"), *[F.col(f"`{c}`") for c in kept])
    same = F.when(F.col("_own") == F.col("_digest"), F.col(n_tokens)).otherwise(F.raise_error(F.lit("rows came in another order when they were read again; write the table first")).cast("long"))
    return rest.join(totals, "_row", "left").select(*[F.col(f"`{c}`") for c in kept], same.alias(n_tokens))


def _piece_counts(model, distinct: list[str]) -> dict[str, int]:
    """Pieces of each distinct pre-token, by the library's own merging."""
    merger = _merger(model)
    out = {}
    for i in range(0, len(distinct), 10_000):
        part = distinct[i : i + 10_000]
        out |= zip(part, map(len, merger.encode_batch(part, add_special_tokens=False)))
    return out | dict.fromkeys(model.special, 1)


def _merger(model):
    """The file's merges alone: what it gets is already one pre-token."""
    if not hasattr(model, "_merger"):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(model.spec) | {"normalizer": None, "added_tokens": []}
        spec["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        model._merger = Tokenizer.from_str(json.dumps(spec))
    return model._merger
