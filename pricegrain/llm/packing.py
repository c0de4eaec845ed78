"""Best-fit packing by planning on a length histogram.

Documents are tokenized and cut at the sequence length. Best-fit decreasing then runs over counts of
lengths, not over documents: open sequences are kept as runs that share their free space, and a whole
run takes a length in one step. The plan's size depends on the number of distinct lengths (at most
the sequence length) alone. Pieces take their planned slots by their rank within their length.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from bisect import bisect_left, insort
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mapped, ranked

END = np.array([1], "<u4").tobytes()
#: Characters whose lower case, normal form and word class need no tables: such a text is split at white
#: space, and every word has the same ids alone as in its text. Other texts go to the tokenizer whole.
_PLAIN = re.compile("[\t\n\r -~¡-¬®-įı-ɏ]*")
_LETTER, _NUMBER = "a-zªµºß-öø-ɏ", "0-9²³¹¼½¾"
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER}]+")
#: Words in a generation of a worker's memory, characters looked up at once, longest part merged here.
REMEMBER, AT_ONCE, LONGEST = 200_000, 1 << 20, 64
NEVER = np.int32(1 << 30)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts as little-endian 32-bit bytes.

    A worker remembers the ids of the words it has met. New words are cut into the tokenizer's parts, and the
    merges of many new parts run at once over arrays; the tokenizer itself encodes what isn't plain, special tokens such as ``<|endoftext|>`` included.
    """

    _open: dict = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Memory()
        whole = json.loads(self.tokenizer.to_str())
        model, self.special = whole["model"], [x["content"] for x in whole["added_tokens"]]
        ids = model["vocab"]
        shown = byte_letters()
        self.inner = np.array([ids.get(c, -1) for c in shown], np.int64)
        self.last = np.array([ids.get(c + model["end_of_word_suffix"], -1) for c in shown], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([ids[a] << 16 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order.astype(np.int32)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.simple = max(ids.values()) < 1 << 16 and (self.inner >= 0).all() and (self.last >= 0).all()

    @classmethod
    def forget(cls) -> None:
        """Drop the words that this process has met; the next task meets others."""
        for encoder in cls._open.values():
            encoder.words = Memory()

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 16 | b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NEVER)

    def merge(self, parts: list[bytes]) -> list[bytes]:
        """Ids of parts of one length in bytes: the lowest-ranked pair, leftmost first, until none is left."""
        raw = np.frombuffer(b"".join(parts), np.uint8).reshape(len(parts), -1)
        s = self.inner[raw]
        s[:, -1] = self.last[raw[:, -1]]
        n = np.full(len(s), s.shape[1])
        done = np.zeros_like(s)
        rows = np.arange(len(s))
        r = self.ranks(s[:, :-1], s[:, 1:])
        while True:
            if r.shape[1]:
                at = r.argmin(1)
                best = r[np.arange(len(r)), at]
                go = best < NEVER
            else:
                go = np.zeros(len(s), bool)
            if not go.all():
                done[rows[~go], : s.shape[1]] = s[~go]
                s, r, rows = s[go], r[go], rows[go]
                if not len(rows):
                    break
                at, best = at[go], best[go]
            i = np.arange(len(s))
            s[i, at] = self.made[best]
            n[rows] -= 1
            column = np.arange(s.shape[1] - 1)
            s = np.take_along_axis(s, column + (column > at[:, None]), 1)
            column = np.arange(r.shape[1] - 1)
            r = np.take_along_axis(r, column + (column >= at[:, None] + 1), 1)
            size = n[rows]
            left, right = at > 0, at + 1 < size
            r[i[left], at[left] - 1] = self.ranks(s[i[left], at[left] - 1], s[i[left], at[left]])
            r[i[right], at[right]] = self.ranks(s[i[right], at[right]], s[i[right], at[right] + 1])
        flat = done.astype("<u4")
        return [row[:k].tobytes() for row, k in zip(flat, n.tolist())]

    def learn(self, words: set[str]) -> None:
        """Ids of new words. One of letters alone is a part; the parts of the others are remembered like words."""
        whole = {w for w in words if w.isalpha()}
        rest = list(words - whole)
        cut_up = list(map(_PARTS.findall, rest))
        by_size: dict[int, list] = {}
        for p in whole | self.words.missing(set(chain.from_iterable(cut_up)) - whole):
            raw = p.encode()
            if self.simple and len(raw) <= LONGEST:
                by_size.setdefault(len(raw), []).append((p, raw))
            else:
                self.words.young[p] = self.ids(p)
        for some in by_size.values():
            self.words.young.update(zip([p for p, _ in some], self.merge([raw for _, raw in some])))
        get = self.words.young.__getitem__
        self.words.young.update(zip(rest, [b"".join(map(get, ps)) for ps in cut_up]))

    def encode(self, texts: list[str | None]):
        """(index, ids and a final 1) of each text, in any order."""
        waiting, size = [], 0
        for i, t in enumerate(texts):
            if not t:
                yield i, END
            elif not _PLAIN.fullmatch(t) or any(x in t for x in self.special):
                yield i, self.ids(t) + END
            else:
                waiting.append((i, t.lower().split()))
                size += len(t)
                if size >= AT_ONCE:
                    yield from self.look_up(waiting)
                    waiting, size = [], 0
        yield from self.look_up(waiting)

    def look_up(self, waiting):
        self.words.turn()
        get, found, gaps = self.words.young.get, [], []
        for _, words in waiting:
            ids = list(map(get, words))
            found.append(ids)
            gaps.append([k for k, x in enumerate(ids) if x is None])
        new = self.words.missing({words[k] for (_, words), ks in zip(waiting, gaps) for k in ks})
        if new:
            self.learn(new)
        known = self.words.young
        for (i, words), ids, ks in zip(waiting, found, gaps):
            for k in ks:
                ids[k] = known[words[k]]
            yield i, b"".join(ids) + END


class Memory:
    """Two generations of what has been met: when the young one is full, it replaces the old one."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self.young) > REMEMBER:
            self.young, self.old = {}, self.young

    def missing(self, keys: set[str]) -> set[str]:
        """Those of ``keys`` that aren't known; the known ones are in the young generation afterwards."""
        away = keys.difference(self.young)
        again = set(filter(self.old.__contains__, away))  # set.intersection would walk the whole dictionary
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        return away - again


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies show for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, vocabulary: str | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every row: its ids and a final 1, cut every ``length`` ids."""
    path, width = vocabulary or default_vocabulary(), 4 * length

    def run(texts):
        out: list = [None] * len(texts)
        gc.disable()  # long lists of words hold no cycles; walking them again and again costs a tenth of the time
        for i, raw in Encoder.at(path).encode(texts):
            out[i] = [(k, k * length, len(part) // 4, zlib.crc32(part)) for k in range(-(-len(raw) // width)) if (part := raw[k * width : (k + 1) * width])]
        gc.enable()
        return ([[dict(zip(("piece", "start", "length", "ids_crc32"), x)) for x in xs] for xs in out],)

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return mapped(narrow, ["id"], ["t"], "p array<struct<piece:int,start:long,length:long,ids_crc32:long>>", run, Encoder.forget).select("id", F.explode("p").alias("p")).select("id", "p.*")


def plan(counts: dict[int, int], capacity: int) -> tuple[dict[int, list[tuple[int, int, int]]], int]:
    """Best-fit decreasing over counts: for each length its runs (first rank, first sequence, offset), and the
    number of sequences. Sequences of a run follow each other in number."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    free: list[int] = []  # amounts of free space that some open run has, ascending
    open_: dict[int, list[tuple[int, int]]] = {}  # free space: runs (first sequence, how many)
    n = 0

    def leave(space, first, many):
        if space and many:
            if space not in open_:
                open_[space] = []
                insort(free, space)
            open_[space].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, left, own = 0, counts[length], runs.setdefault(length, [])
        while left:
            at = bisect_left(free, length)
            if at < len(free):
                space = free[at]
                first, many = open_[space].pop()
                if not open_[space]:
                    del open_[space]
                    free.pop(at)
            else:
                per = capacity // length  # new sequences: as many as this length alone would fill
                first, many, space = n, -(-left // per), capacity
                n += many
            use = min(many, left)
            own.append((rank, first, capacity - space))
            leave(space - length, first, use)
            leave(space, first + use, many - use)
            rank, left = rank + use, left - use
    return runs, n


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, vocabulary: str | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row.

    Null and empty texts are one piece of the final id alone; texts longer than ``length`` ids, and only
    they, are cut. Rows that repeat are packed each by itself, and equal pieces are interchangeable; an
    empty table gives an empty one. Other columns are ignored.
    """
    rows = ranked(cut(pieces(docs, id_col, text_col, length, vocabulary)), ["length"], ["id", "piece", "ids_crc32"])
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most `length` rows
    runs, _ = plan(counts, length)
    tables = {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in runs.items()}

    def run(lengths, ranks):
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        lengths, ranks = np.array(lengths, np.int64), np.array(ranks, np.int64)
        for k in np.unique(lengths):
            own = lengths == k
            first, base, place = tables[int(k)]
            at = np.searchsorted(first, ranks[own], "right") - 1
            sequence[own] = base[at] + ranks[own] - first[at]
            offset[own] = place[at]
        return sequence, offset

    out = mapped(rows, ["id", "piece", "start", "length", "ids_crc32"], ["length", "rank"], "sequence_id long, offset long", run)
    return out.withColumnRenamed("id", id_col)
