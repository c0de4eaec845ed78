"""Removal of long repeated byte strings by a sampled suffix array.

Every ``least``-byte window picks one anchor: the position with the smallest hash among its first
positions. The choice depends on the window's bytes alone, so equal windows have equal anchors at equal
offsets, and only suffixes that start at anchors need sorting, together with the bytes before them. An
anchor covers a run of offsets; all its windows share a core of bytes, and an anchor whose core occurs
once in the corpus is done.

The other anchors' suffixes are range-partitioned by their leading bytes (Spark samples the splitters).
A bucket sorts its suffixes by multikey quicksort on 8-byte words, which also yields the lengths of
common prefixes. Then offsets grow byte by byte to the left: anchors stay together while they agree on
the bytes before them, and a window repeats if a neighbour in that order shares enough bytes to the
right. Suffixes with one core meet in one bucket, so that nothing is left to compare across its
boundaries; a core that more than ``cap`` anchors share is cut beforehand into narrower runs of offsets
with longer cores, at last into single windows, which repeat if they occur twice.

Equal texts are processed once; a text that occurs twice repeats from end to end. Anchors whose contexts
(all bytes of their windows) are equal are one: two of them repeat as a whole, and only contexts that differ
around an equal core send bytes to a bucket, one text lending them for all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mapped

#: Offsets that one anchor may cover, and how a hot core's run of offsets is cut in turn.
REACH = 256
NARROWER = {256: 32, 32: 4, 4: 1}
#: Suffixes to a bucket, on average, and bytes hashed at once.
BUCKET, STEP = 16_000, 1 << 19


def anchors(raw: np.ndarray, least: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, lowest offset, highest offset) of the anchors of a text's windows of ``least`` bytes."""
    out = []
    windows = len(raw) - least + 1
    for a in range(0, max(0, windows), STEP):
        b = min(windows, a + STEP)
        part = raw[a : b + reach + 6].astype(np.uint64)
        h = np.zeros(b - a + reach - 1, np.uint64)
        for k in range(8):
            h = (h ^ part[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        # the low 20 bits give way to the position, so that the smallest value names its leftmost place
        h = h & ~np.uint64((1 << 20) - 1) | np.arange(len(h), dtype=np.uint64)
        # smallest of each `reach` positions: prefix and suffix minima of blocks
        full = -(-len(h) // reach) * reach
        grid = np.full(full, np.iinfo(np.uint64).max, np.uint64)
        grid[: len(h)] = h
        grid = grid.reshape(-1, reach)
        front = np.minimum.accumulate(grid, axis=1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        low = np.minimum(back[: b - a], front[reach - 1 : reach - 1 + b - a])
        out.append((low & np.uint64((1 << 20) - 1)).astype(np.int64) + a)
    if not out:
        return (np.zeros(0, np.int64),) * 3
    pick = np.concatenate(out)
    at = np.concatenate(([0], np.flatnonzero(np.diff(pick)) + 1))
    last = np.concatenate((at[1:], [len(pick)])) - 1
    return pick[at], pick[at] - last, pick[at] - at


def entries(raw: bytes, least: int, reach: int, hot: set[int]):
    """(position, lowest, highest offset, hash of the core, hash of the context) of a text's anchors.

    A context is the bytes of all windows of the anchor. Hot cores are narrowed to fewer offsets, at last to a
    single window, whose core and context are the same bytes under two independent hashes.
    """
    for p, low, high in zip(*(x.tolist() for x in anchors(np.frombuffer(raw, np.uint8), least, reach))):
        waiting = [(reach, 0)]
        while waiting:
            width, k = waiting.pop()
            h = xxhash.xxh64_intdigest(raw[p - k : p + least - k - width + 1], width << 16 | k)
            h -= (h >> 63) << 64
            if h in hot and width > 1:
                step = NARROWER[width]
                waiting += [(step, j) for j in range(k, k + width, step) if j <= high and j + step > low]
                continue
            a, b = max(low, k), min(high, k + width - 1)
            c = xxhash.xxh64_intdigest(raw[p - b : p + least - a], 1 << 40 | a << 16 | b)
            yield p, a, b, h, c - ((c >> 63) << 64)


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """Leading zero bytes of 64-bit words."""
    return sum((x < np.uint64(1 << (8 * k))).astype(np.int64) for k in range(1, 8)) + (x == 0)


def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of 64-bit words, and the bytes that each row shares with the one before it.

    One word at a time over all groups that are still equal; a group of one is left alone.
    """
    m, depth = words.shape
    order, group, shared = np.arange(m), np.zeros(m, np.int64), np.zeros(m, np.int64)
    open_ = np.arange(m) if m > 1 else np.arange(0)
    for d in range(depth):
        if not len(open_):
            break
        w, g = words[order[open_], d], group[open_]
        by = np.lexsort((w, g))
        order[open_], w = order[open_][by], w[by]
        new = np.ones(len(open_), bool)
        same = g[1:] == g[:-1]
        new[1:] = ~same | (w[1:] != w[:-1])
        split = np.flatnonzero(same & new[1:]) + 1
        shared[open_[split]] = 8 * d + shared_bytes(w[split] ^ w[split - 1])
        start = open_[np.flatnonzero(new)]
        run = np.cumsum(new) - 1
        group[open_] = start[run]
        many = np.bincount(run)[run] > 1
        open_ = open_[many]
    if len(open_):
        inner = open_[1:][group[open_[1:]] == group[open_[:-1]]]
        shared[inner] = 8 * depth
    return order, shared


class Lowest:
    """Smallest of any stretch of an array."""

    def __init__(self, x: np.ndarray):
        self.table = [x.astype(np.int16)]
        while 2 << (len(self.table) - 1) <= len(x):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def over(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the positions a .. b, both included."""
        level = np.log2(b - a + 1).astype(np.int64)
        out = np.empty(len(a), np.int16)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.table[k][a[own]], self.table[k][b[own] - (1 << int(k)) + 1])
        return out


def repeated(contexts: list[bytes], left: np.ndarray, low: np.ndarray, high: np.ndarray, least: int, reach: int) -> np.ndarray:
    """Whether the window of each context at each offset (columns) occurs in another context too.

    ``left`` is how many bytes of a context stand before its anchor; windows start ``low`` to ``high``
    bytes before it.
    """
    m, width = len(contexts), -(-least // 8) * 8
    right, before = np.zeros((m, width), np.uint8), np.zeros((m, reach), np.uint8)
    for i, (c, k) in enumerate(zip(contexts, left.tolist())):
        raw = np.frombuffer(c, np.uint8)
        right[i, : min(least, len(raw) - k)] = raw[k : k + least]
        before[i, :k] = raw[:k][::-1]
    order, shared = multikey_sort(right.view(">u8").astype(np.uint64))
    before, low, high = before[order], low[order], high[order]
    lowest, found = Lowest(shared), np.zeros((m, reach), bool)
    items = np.arange(m)
    group = np.cumsum(np.concatenate(([True], shared[1:] < least - reach + 1))) - 1 if m else items
    for o in range(reach):
        if o:
            stay = high[items] >= o
            items, group = items[stay], group[stay]
            key = group * 256 + before[items, o - 1]
            by = np.argsort(key, kind="stable")
            items, key = items[by], key[by]
            group = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))) - 1 if len(key) else key
        size = np.bincount(group)[group] if len(group) else group
        items, group = items[size > 1], group[size > 1]
        if not len(items):
            break
        group = np.cumsum(np.concatenate(([True], group[1:] != group[:-1]))) - 1
        now = low[items] <= o
        a, g = items[now], group[now]
        pair = np.flatnonzero(g[1:] == g[:-1])
        if len(pair):
            hit = pair[lowest.over(a[pair] + 1, a[pair + 1]) >= least - o]
            found[a[hit], o] = found[a[hit + 1], o] = True
    out = np.empty_like(found)
    out[order] = found
    return out


def stretches(offsets) -> list[int]:
    """First and last of each run of consecutive numbers, in one flat list."""
    out: list[int] = []
    for o in offsets:
        if out and o == out[-1] + 1:
            out[-1] = o
        else:
            out += [o, o]
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 400, reach: int = REACH, cap: int = 40_000) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    A byte goes if a string of ``least`` bytes that covers it also starts anywhere else, in the same text
    or another; all strings are judged on the input. Null texts are empty; texts shorter than ``least``
    keep all; rows that repeat are occurrences like any other; an empty table gives an empty one; null
    ids are kept; other columns are ignored. ``reach`` offsets (256 or less) may share an anchor.
    """
    code = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8")
    rows = docs.select(F.col(id_col).alias("id"), code.alias("raw")).withColumn("key", F.unhex(F.substring(F.sha2("raw", 256), 1, 32)))
    long_rows = rows.where(F.length("raw") >= least).select("key", "raw")

    def listed(df: DataFrame) -> DataFrame:
        """(key, h, c, local): cores and contexts of each text, and how often it has them."""
        hot = ["hot"] if "hot" in df.columns else []

        def run(raws, hots=None):
            out = []
            for i, raw in enumerate(raws):
                own, seen = set(hots[i] or ()) if hots else set(), {}
                for _, _, _, h, c in entries(raw, least, reach, own):
                    seen[h, c] = seen.get((h, c), 0) + 1
                out.append([{"h": h, "c": c, "local": n} for (h, c), n in seen.items()])
            return (out,)

        return mapped(df, ["key"], ["raw", *hot], "e array<struct<h:long,c:long,local:long>>", run).select("key", F.explode("e").alias("e")).select("key", "e.*")

    def shared(cores: DataFrame) -> DataFrame:
        """Cores that two texts have, or one text twice."""
        mark = F.xxhash64("key")
        out = cores.groupBy("h").agg(F.min(mark).alias("a"), F.max(mark).alias("b"), F.max("local").alias("local"), F.min("c").alias("c"), F.max("c").alias("d"))
        return out.where("a <> b OR local > 1 OR c <> d").select("h")

    cores, source = cut(shared(listed(long_rows))), long_rows
    while True:
        # Every text's contexts with shared cores, and what is known of each context as a whole.
        # The changed core keeps the aggregate from resting on the join's partitions, where a common core's rows
        # would meet in one task before they are combined.
        mine = listed(source).join(cores, "h").groupBy("key", F.col("h").bitwiseXOR(F.lit(1)).alias("g"), "c")
        have = cut(mine.agg(F.max("local").alias("local")).select("key", F.col("g").bitwiseXOR(F.lit(1)).alias("h"), "c", "local"))
        classes = cut(have.groupBy("h", "c").agg(F.min("key").alias("rep"), F.max("key").alias("other"), F.max("local").alias("local")))
        wide = classes.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        hot = wide.where(F.col("n") > cap).select("h")
        if not hot.limit(1).count():
            break
        marked = have.join(hot, "h", "left_semi").select("key", "h")
        if "hot" in source.columns:
            marked = marked.union(source.select("key", F.explode("hot").alias("h")))
        marked = cut(marked.groupBy("key").agg(F.collect_set("h").alias("hot")))
        source = long_rows.join(marked, "key", "left")
        cores = cut(cores.join(hot, "h", "left_anti").union(shared(listed(source.where("hot IS NOT NULL")))).distinct())
    known = (F.col("rep") != F.col("other")) | (F.col("local") > 1)
    classes = classes.join(wide, "h", "left").withColumn("known", known)
    # One text lends the bytes of each context whose core has several.
    lent = cut(classes.where("n > 1").groupBy(F.col("rep").alias("key")).agg(F.collect_list(F.struct("h", "c", "known")).alias("x"), F.count(F.lit(1)).alias("n_x")))
    packed = mapped(rows, ["id", "key"], ["raw"], "z binary", lambda raws: ([zstandard.compress(r, 3) for r in raws],))
    texts = packed.groupBy("key").agg(F.first("z").alias("z"), F.count(F.lit(1)).alias("copies"))
    with_hot = texts.join(lent, "key")
    with_hot = with_hot.join(marked, "key", "left") if "hot" in source.columns else with_hot.withColumn("hot", F.lit(None).cast("array<long>"))

    def contexts(zs, wants, hots):
        out = []
        for z, want, own in zip(zs, wants, hots):
            raw, left, found = zstandard.decompress(z), {(x["h"], x["c"]): x["known"] for x in want}, []
            for p, low, high, h, c in entries(raw, least, reach, set(own or ())):
                if (h, c) in left:
                    found.append({"lead": raw[p : p + 16], "h": h, "c": c, "low": low, "high": high, "context": raw[p - high : p + least - low], "known": left.pop((h, c))})
            out.append(found)
        return (out,)

    kinds = "array<struct<lead:binary,h:long,c:long,low:int,high:int,context:binary,known:boolean>>"
    found = mapped(with_hot, ["key"], ["z", "x", "hot"], f"f {kinds}", contexts).select(F.explode("f").alias("f")).select("f.*")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(lent.agg(F.sum("n_x")).first()[0] or 0) // BUCKET))

    def bucket(batches):
        every = list(batches)
        if not every:
            return
        table = pa.Table.from_batches(every)
        low, high, h, c = (table.column(k).to_numpy().astype(np.int64) for k in ("low", "high", "h", "c"))
        if not len(h):
            return
        hit = repeated(table.column("context").to_pylist(), high, low, high, least, reach)
        fresh = ~np.array(table.column("known").to_pylist(), bool) & hit.any(1)
        offsets = [stretches(np.flatnonzero(hit[i]).tolist()) for i in np.flatnonzero(fresh)]
        yield pa.RecordBatch.from_arrays([pa.array(h[fresh]), pa.array(c[fresh]), pa.array(offsets, pa.list_(pa.int32()))], names=["h", "c", "offsets"])

    partly = cut(found.repartitionByRange(parts, "lead", "h").mapInArrow(bucket, "h long, c long, offsets array<int>"))
    # All offsets of a known context, the offsets found of the others.
    whole = classes.where("known").select("h", "c", F.lit(None).cast("array<int>").alias("offsets"))
    spans = cut(have.select("key", "h", "c").join(whole.union(partly), ["h", "c"]).groupBy("key").agg(F.collect_list(F.struct("h", "c", "offsets")).alias("x")))
    given = texts.join(spans, "key", "left")
    given = given.join(marked, "key", "left") if "hot" in source.columns else given.withColumn("hot", F.lit(None).cast("array<long>"))

    def judge(zs, copies, given_, hots):
        out = []
        for z, n, x, own in zip(zs, copies, given_, hots):
            raw, merged = zstandard.decompress(z), []
            if n > 1 and len(raw) >= least:
                merged = [[0, len(raw)]]
            elif x:
                offsets, found = {(y["h"], y["c"]): y["offsets"] for y in x}, []
                for p, low, high, h, c in entries(raw, least, reach, set(own or ())):
                    if (h, c) in offsets:
                        flat = offsets[h, c] or (low, high)
                        found += [(p - b, p - a + least) for a, b in zip(flat[::2], flat[1::2])]
                for a, b in sorted(found):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
            kept, at = hashlib.sha256(), 0
            for a, b in merged:
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            out.append((len(raw), sum(b - a for a, b in merged), len(merged), kept.hexdigest()))
        return tuple(zip(*out)) or ((),) * 4

    judged = mapped(given, ["key"], ["z", "copies", "x", "hot"], "n_bytes long, n_removed long, n_spans long, kept_sha256 string", judge)
    return rows.select("id", "key").join(judged, "key").select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")
