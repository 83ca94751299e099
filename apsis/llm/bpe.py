"""BPE encoding and decoding by speculation and verification, and the pre-tokenisation that token counts share.

A word (pre-token) is first cut greedily into the longest vocabulary entries. The proposal equals the merge result
exactly when no adjacent pair of proposed tokens could have merged across its seam; that test needs only the ranks on
the right spine of the left token and the left spine of the right one, and runs in numpy over all new pairs at once.
Words that fail are merged exactly, lowest rank first. Each task keeps a bounded memory of words it has encoded.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import give_back, without

#: Texts of these characters only take the fast path: composed ones whose lower case is one too; their classes are listed below.
_PLAIN = set(map(chr, [9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x250)]))
FAST = re.compile("[" + "".join(re.escape(c) for c in sorted(_PLAIN) if _PLAIN.issuperset(c.lower())) + "]*")
#: The file's split pattern with letters and numbers spelt out for the range above, after lower-casing.
FAST_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ɏ]+|[0-9²³¹¼½¾]|[^\\sa-zªµºß-öø-ɏ0-9²³¹¼½¾]+")
#: Bytes of text, or of ids, whose results are held at once.
PART_BYTES = 1_000_000
#: Words remembered by a task before its memory is emptied, and the letters of those that are remembered at all.
MEMORY_WORDS, MEMORY_LETTERS = 200_000, 64
END = "\x01"
SUFFIX = "</w>"


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 for itself, the rest from 256 upwards."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


@dataclass
class Model:
    """What a task needs of a tokenizer file."""

    spec: str
    tokens: list[str] = field(default_factory=list)
    ids: dict[str, int] = field(default_factory=dict)
    prefixes: dict[str, int] = field(default_factory=dict)
    ranks: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)
    special: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        spec = json.loads(self.spec)
        vocab = {k: i for k, i in spec["model"]["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for a in spec["added_tokens"]:
            assert not (a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]), "unsupported special token"
        assert spec["model"]["end_of_word_suffix"] == SUFFIX and not spec["model"]["ignore_merges"], "unsupported model"
        everything = vocab | self.special
        self.tokens = [""] * (max(everything.values()) + 1)
        for k, i in everything.items():
            self.tokens[i] = k
        self.ids = {k.removesuffix(SUFFIX) + END * k.endswith(SUFFIX) if k != SUFFIX else k: i for k, i in vocab.items()}
        self.chars = byte_chars()
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        n = len(self.tokens)
        born, left, right = np.full((3, n), -1, np.int32)
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.ranks[x, y] = (rank, z)
            if born[z] < 0:
                born[z], left[z], right[z] = rank, x, y
        self._spines(born, left, right)
        self._propose_from(born)
        self.known_pairs = np.empty(0, np.int64)
        self.known_fit = np.empty(0, bool)
        self.memory: dict[str, bytes] = {}

    def _spines(self, born, left, right):
        """For each token, the parts along its left and right edge with the rank at which each is merged away."""
        never = np.iinfo(np.int32).max
        self.edges = {}
        for name, down in (("left", left), ("right", right)):
            part, death = np.arange(len(born), dtype=np.int32), np.full(len(born), never, np.int32)
            parts, deaths = [part], [death]
            while True:
                deeper = np.where(part >= 0, down[part], np.int32(-1))
                if (deeper < 0).all():
                    break
                death = np.where(deeper >= 0, born[part], np.int32(-1))
                part = deeper
                parts.append(part)
                deaths.append(death)
            self.edges[name] = (np.stack(parts), np.stack(deaths))
        keys = np.array([x << 32 | y for x, y in self.ranks], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.ranks.values()], np.int64)[order]

    def _propose_from(self, born):
        """Prefixes of the entries that merging can reach: id of the entry, or -1 for a mere prefix."""
        for k, i in self.ids.items():
            if born[i] >= 0 and self.merge(k) != [i]:
                continue
            if born[i] < 0 and len(k.rstrip(END)) != 1:
                continue
            for j in range(1, len(k)):
                self.prefixes.setdefault(k[:j], -1)
            self.prefixes[k] = i

    def merge(self, word: str) -> list[int]:
        """Exact merging of a word given in byte characters, closed by END: lowest rank first, leftmost first."""
        symbols = list(word[:-1]) if word.endswith(END) else list(word)
        if word.endswith(END):
            symbols[-1] += END
        part = [self.ids[s] for s in symbols]
        n = len(part)
        if n <= 64:  # a scan for the lowest rank beats a heap
            get, none = self.ranks.get, (1 << 60, 0)
            ranks = [get(p, none) for p in zip(part, part[1:])]
            while ranks:
                lowest = min(ranks)
                if lowest is none:
                    break
                i = ranks.index(lowest)
                part[i : i + 2] = [lowest[1]]
                del ranks[i]
                if i:
                    ranks[i - 1] = get((part[i - 1], part[i]), none)
                if i < len(ranks):
                    ranks[i] = get((part[i], part[i + 1]), none)
            return part
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.ranks[p][0], i, *p) for i in range(n - 1) if (p := (part[i], part[i + 1])) in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = after[i]
            if part[i] != x or j >= n or part[j] != y:
                continue
            part[i], part[j] = self.ranks[x, y][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := (part[a], part[b])) in self.ranks:
                    heapq.heappush(heap, (self.ranks[p][0], a, *p))
        return [p for p in part if p >= 0]

    def propose(self, word: str) -> list[int]:
        """Greedy longest match; [] where it gets stuck."""
        out, i, n, known = [], 0, len(word), self.prefixes
        while i < n:
            best, j = -1, i + 1
            while (hit := known.get(word[i:j])) is not None and j <= n:
                if hit >= 0 and j != n - 1:
                    best, stop = hit, j
                j += 1
            if best < 0:
                return []
            out.append(best)
            i = stop
        return out

    def fit(self, keys: np.ndarray) -> np.ndarray:
        """Whether each pair, given as left << 32 | right, survives merging side by side."""
        a, b = keys >> 32, keys & 0xFFFFFFFF
        fits = np.ones(len(keys), bool)
        (xs, xdeath), (ys, ydeath) = self.edges["right"], self.edges["left"]
        for i in range(len(xs)):
            live_x = np.flatnonzero(fits & (xs[i][a] >= 0))
            if not len(live_x):
                break
            for j in range(len(ys)):
                live = live_x[ys[j][b[live_x]] >= 0]
                if not len(live):
                    break
                x, y = xs[i][a[live]], ys[j][b[live]]
                seam = x.astype(np.int64) << 32 | y
                at = np.minimum(np.searchsorted(self.pair_keys, seam), len(self.pair_keys) - 1)
                rank = self.pair_ranks[at]
                # The seam merges if its pair comes up before either part is merged away; at a tie the left pair goes first.
                broken = (self.pair_keys[at] == seam) & (rank < xdeath[i][a[live]]) & (rank <= ydeath[j][b[live]])
                fits[live[broken]] = False
        return fits

    def learn(self, words: Iterable[str]) -> None:
        """Put the encodings of new words into memory."""
        words = list(words)
        chars = self.chars
        mapped = [w if w.isascii() and w.isalnum() else "".join([chars[b] for b in w.encode()]) for w in words]
        mapped = [m + END for m in mapped]
        proposals = [self.propose(m) for m in mapped]
        lens = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(lens.sum()))
        bad = lens == 0
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(words)), lens)
            inside = owner[1:] == owner[:-1]
            pairs, where = np.unique(flat[:-1][inside] << 32 | flat[1:][inside], return_inverse=True)
            if len(pairs):
                at = np.minimum(np.searchsorted(self.known_pairs, pairs), max(len(self.known_pairs) - 1, 0))
                seen = self.known_pairs[at] == pairs if len(self.known_pairs) else np.zeros(len(pairs), bool)
                fits = np.empty(len(pairs), bool)
                fits[seen] = self.known_fit[at[seen]]
                fits[~seen] = self.fit(pairs[~seen])
                if len(self.known_pairs) > 4 * MEMORY_WORDS:
                    self.known_pairs, self.known_fit, seen = self.known_pairs[:0], self.known_fit[:0], np.zeros(len(pairs), bool)
                both = np.concatenate([self.known_pairs, pairs[~seen]])
                order = np.argsort(both, kind="stable")
                self.known_pairs, self.known_fit = both[order], np.concatenate([self.known_fit, fits[~seen]])[order]
                bad[owner[1:][inside][~fits[where.reshape(-1)]]] = True
        packed, ends = flat.astype("<u4").tobytes(), np.cumsum(lens) * 4
        starts = ends - lens * 4
        for w, m, wrong, s, e in zip(words, mapped, bad.tolist(), starts.tolist(), ends.tolist()):
            self.memory[w] = np.array(self.merge(m), "<u4").tobytes() if wrong else packed[s:e]

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        group: list[list[str]] = []
        size = 0
        for text in texts:
            group.append(self.pre_tokens(text or ""))
            size += len(group[-1])
            if size > 100_000:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, group: list[list[str]]) -> Iterator[bytes]:
        if len(self.memory) > MEMORY_WORDS:
            self.memory.clear()
        if not self.memory:
            self.memory |= {k: np.array([i], "<u4").tobytes() for k, i in self.special.items()}
        new = set().union(*group).difference(self.memory)
        if new:
            self.learn(new)
        get = self.memory.__getitem__
        for ws in group:
            yield b"".join(map(get, ws))
        for w in new:
            if len(w) > MEMORY_LETTERS:
                del self.memory[w]

    def decode(self, packed: bytes | None) -> str:
        """The tokens of packed ids, joined by one blank, as a tokenizer file without a decoder decodes."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(packed or b"", "<u4").tolist()))

    def pre_tokens(self, text: str) -> list[str]:
        """The words that merging works on; a special token of the file is a word of its own."""
        if self.split_special is not None and "<|" in text:
            out = []
            for part in self.split_special.split(text):
                out += [part] if part in self.special else self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if FAST.fullmatch(text):
            return FAST_SPLIT.findall(text.lower())
        library = self.library
        return [text_of(p) for p, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))]

    @property
    def library(self):
        """The tokenizers library's own normaliser and splitter, for texts beyond the fast range."""
        if not hasattr(self, "_library"):
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.spec)
        return self._library


_BACK = {c: b for b, c in enumerate(byte_chars())}


def text_of(piece: str) -> str:
    """Undo the byte characters of one piece of the splitter."""
    return bytes(_BACK[c] for c in piece).decode()


class Vocabulary:
    """A tokenizer file, read on the driver and sent once to each executor; its size is fixed by the file.

    A Python worker makes the model once and keeps it with its broadcast, so it drops both when a task of another stage comes
    to it. The driver makes none.
    """

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            spec = f.read()
        assert len(spec) < 64_000_000, "a vocabulary file of more than 64 MB"
        self.spec = spark.sparkContext.broadcast(spec)

    def model(self) -> Model:
        if not hasattr(self.spec, "made"):
            self.spec.made = Model(self.spec.value)
        return self.spec.made


def map_parts(batches, source: str):
    """Batches cut so that a part holds PART_BYTES of a column, or one row that is longer."""
    for batch in batches:
        column = batch.column(batch.schema.names.index(source))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            size = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART_BYTES, "right")) - at
            yield batch.slice(at, max(1, size))
            at += max(1, size)


def _adding(df: DataFrame, source: str, added: list[tuple[str, T.DataType]], work) -> DataFrame:
    """df with columns made from one of its columns, batch by batch."""
    kept = without(df, *[name for name, _ in added if name != source])
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in added]])
    kinds = [pa.large_binary() if t == T.BinaryType() else pa.large_string() if t == T.StringType() else pa.int64() for _, t in added]

    def run(batches):
        for batch in map_parts(batches, source):
            made = work(batch.column(batch.schema.names.index(source)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(m, k) for m, k in zip(made, kinds)]], names=[*batch.schema.names, *[n for n, _ in added]]
            )
        batch = made = None
        give_back()

    return kept.mapInArrow(run, schema)


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens", decoded: str | None = None) -> DataFrame:
    """df with token ids (binary, little-endian unsigned 32-bit), their number, and if asked the text decoded from the ids.

    A null text counts as empty and has no ids; every row gives one row, repeated rows too; an input column of a result's
    name is replaced; an empty table gives an empty table.
    """
    added = [(ids, T.BinaryType()), (n_tokens, T.LongType()), *([(decoded, T.StringType())] if decoded else [])]

    def work(column):
        model = vocabulary.model()
        packed = list(model.encode(x.as_py() for x in column))
        return [packed, [len(p) // 4 for p in packed], *([map_list(model.decode, packed)] if decoded else [])]

    return _adding(df, text, added, work)


def map_list(f, xs):
    return [f(x) for x in xs]


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """df with the text of packed ids; null ids decode to the empty text."""
    return _adding(df, ids, [(decoded, T.StringType())], lambda column: [map_list(vocabulary.model().decode, column.to_pylist())])
