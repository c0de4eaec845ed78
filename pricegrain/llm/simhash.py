"""SimHash near-duplicates: 64-bit fingerprints linked within a Hamming radius by sharded BK-trees.

Fingerprints at most ``radius`` bits apart agree in at least one of ``radius + 1`` bit blocks, so each
distinct fingerprint is filed in one shard for each block, by the leading bits of that block (as many
as make shards of a few hundred fingerprints; widths follow the count alone). A shard builds a
BK-tree, whose children are keyed by their integer Hamming distance to the parent, and its members
follow only the edges within the radius. A shard beyond ``SHARD_CAP`` is cut into pieces; the tree of
each piece is sent (a bounded broadcast) to the tasks that hold the other pieces' members. Tasks emit
a spanning forest of the links they find, never the pairs of a group.

``near_copies`` links texts by the similarity of their whole shingle sets. Sets of a similarity of 0.8 differ
in about 10 of 64 bits and at times in over 20, too many for bit blocks, so its shards hold the texts that share a
rare shingle (a prefix filter, which loses no pair); within a shard fingerprints choose the texts that all others
meet first, every pair that can be similar by sizes and places is considered, and whole sets decide. BK-trees serve a
narrower radius, if one is asked for.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, cut, local_components, mapped, tidy

#: Mean and most fingerprints of one shard tree.
SHARD, SHARD_CAP = 512, 1024
#: Shingles unpacked to bits at once.
STEP = 1 << 15
#: Most fingerprints in a leaf, which are compared directly.
LEAF = 8
#: Near copies: counters that the shingles of all texts share by hash (a power of 2), stretches in which tasks send
#: them, and the count from which a shingle comes after others in the order of shingles.
SLOTS, STRETCHES, OFTEN = 1 << 21, 64, 2
#: Postings that a task hands over at once, texts of a shard that all others meet first, keys that are broadcast at
#: most, texts of a block whose sets are held at once, texts that come to a block in one task.
FILED, FIRST, SENT, BLOCK, COME = 1 << 18, 4, 1 << 20, 256, 4096
#: Bits in which fingerprints of near copies may differ: all of them, as any fewer could lose a pair.
WIDE = 64


def hashes(text: str | None, words: int = 3) -> np.ndarray:
    """XXH64 values (seed 42) of a text's word shingles, repeats included; a shorter text is one shingle."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, "<u8")
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], "<u8")
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-words])).tolist()
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b], 42) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())], "<u8")


def majority(values: np.ndarray) -> int:
    """The bits that are set in over half of the values."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(values), STEP):
        votes += np.unpackbits(values[i : i + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(values), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 majority bits over the hashes of a text's word shingles; 0 if it has no word."""
    return majority(hashes(text, words))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp) of each row; null and wordless texts get 0. Other columns are not read."""
    def run(texts):
        return (np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64),)

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return mapped(narrow, ["id"], ["t"], "fp long", run)


class BKTree:
    """BK-tree over distinct unsigned 64-bit values, built and searched for many values at once."""

    def __init__(self, values: np.ndarray):
        self.values = values
        #: of each node: (index of its value, {distance: child}) or, for a leaf, an array of indexes
        self.nodes: list = []
        waiting = [(np.arange(len(values)), None, 0)] if len(values) else []
        while waiting:
            members, parent, edge = waiting.pop()
            at = len(self.nodes)
            if parent is not None:
                self.nodes[parent][1].append((edge, at))
            if len(members) <= LEAF:
                self.nodes.append(members)
                continue
            root, rest = members[0], members[1:]
            self.nodes.append((root, []))
            d = np.bitwise_count(values[rest] ^ values[root])
            order = np.argsort(d, kind="stable")
            rest, d = rest[order], d[order]
            cuts = np.flatnonzero(np.diff(d)) + 1
            for part, first in zip(np.split(rest, cuts), [0, *cuts.tolist()]):
                waiting.append((part, at, int(d[first])))

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query index, value index) at distance <= radius."""
        q_hits, v_hits = [], []
        waiting = [(0, np.arange(len(queries)))] if self.nodes and len(queries) else []
        while waiting:
            at, some = waiting.pop()
            node = self.nodes[at]
            if isinstance(node, np.ndarray):
                i, j = np.nonzero(np.bitwise_count(queries[some][:, None] ^ self.values[node][None, :]) <= radius)
                q_hits.append(some[i])
                v_hits.append(node[j])
                continue
            d = np.bitwise_count(queries[some] ^ self.values[node[0]]).astype(np.int64)
            near = some[d <= radius]
            q_hits.append(near)
            v_hits.append(np.full(len(near), node[0]))
            for edge, child in node[1]:
                follow = some[np.abs(d - edge) <= radius]
                if len(follow):
                    waiting.append((child, follow))
        return (np.concatenate(q_hits), np.concatenate(v_hits)) if q_hits else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def blocks(radius: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of radius + 1 blocks that cover 64 bits."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that join the same values as all pairs of ``distinct.fp`` within the radius do."""
    n = distinct.count()
    wanted = max(0, math.ceil(math.log2(max(1, n) / SHARD)))
    keys = []
    for k, (low, width) in enumerate(blocks(radius)):
        w = min(wanted, width)
        part = F.shiftrightunsigned("fp", low + width - w).bitwiseAND(F.lit((1 << w) - 1))
        keys.append(F.struct(F.lit(k).alias("block"), part.cast("long").alias("prefix")))
    filed = distinct.select("fp", F.explode(F.array(*(keys if wanted else keys[:1]))).alias("s")).select("fp", "s.block", "s.prefix")
    # A shard over the cap is dealt in pieces; the rest keep piece 0 of 1.
    large = filed.groupBy("block", "prefix").count().where(F.col("count") > SHARD_CAP)
    filed = filed.join(large, ["block", "prefix"], "left").select("fp", "block", "prefix", F.coalesce(F.ceil(F.col("count") / SHARD_CAP), F.lit(1)).cast("int").alias("pieces"))
    filed = filed.withColumn("piece", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
    filed = filed.select("*", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
    filed = filed.select("fp", "block", "prefix", F.least("piece", "other").alias("tree"), F.greatest("piece", "other").alias("members"), (F.col("piece") <= F.col("other")).alias("in_tree"))

    def run(frame):
        fp = frame["fp"].to_numpy().view(np.uint64)
        in_tree = frame["in_tree"].to_numpy()
        if frame["tree"].iloc[0] == frame["members"].iloc[0]:
            trees = queries = np.arange(len(fp))
        else:
            trees, queries = np.flatnonzero(in_tree), np.flatnonzero(~in_tree)
        q, v = BKTree(fp[trees]).search(fp[queries], radius)
        label = local_components(len(fp), queries[q], trees[v])
        own = np.flatnonzero(label != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[own].view(np.int64), "b": fp[label[own]].view(np.int64)})

    return filed.groupBy("block", "prefix", "tree", "members").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """(id_col, fingerprint, component_id) of every row of ``docs``.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the
    smallest id reachable. Null, empty and wordless texts have fingerprint 0 and link like any other;
    repeated rows come back as often as they came; an empty table gives an empty one; null ids are
    kept, and a component whose ids are all null has a null ``component_id``. Other columns are ignored.
    """
    prints = cut(fingerprints(docs, id_col, text_col, words))
    distinct = cut(prints.groupBy("fp").agg(F.min("id").alias("least")))
    label = components(links(distinct, radius))
    node = distinct.join(label.withColumnRenamed("id", "fp"), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    least = node.groupBy("label").agg(F.min("least").alias("component_id"))
    known = node.join(least, "label").select("fp", "component_id")
    return prints.join(known, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def need(n, percent: int):
    """Least size of a set, and of the overlap, that reaches ``percent`` with a set of ``n``."""
    return -(-n * percent // 100)


def _slot(items: np.ndarray) -> np.ndarray:
    return (items & np.uint64(SLOTS - 1)).astype(np.int64)


def _counts(texts: DataFrame, words: int) -> np.ndarray:
    """For each counter how many of all texts hold its shingles, each shingle by itself; a map task counts equal texts once.

    These give the order of shingles alone: every total order finds the same pairs, the rarest first with the least work.
    What tasks send grows neither with the shingles nor with the texts of a task.
    """

    @tidy
    def run(batches):
        total, met = np.zeros(SLOTS, np.uint32), set()
        for batch in batches:
            for t, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key not in met:
                    met.add(key)
                    np.add.at(total, _slot(np.unique(hashes(t, words))), 1)
        parts = [zstandard.compress(x.tobytes(), 3) for x in np.split(total, STRETCHES)] if met else []
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["stretch", "counts"])

    @tidy
    def add(batches):
        total = {}
        for batch in batches:
            for k, z in zip(*[c.to_pylist() for c in batch.columns]):
                total[k] = total.get(k, 0) + np.frombuffer(zstandard.decompress(z), np.uint32).astype(np.int64)
        parts = [zstandard.compress(x.tobytes(), 3) for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(parts, pa.binary())], names=["stretch", "counts"])

    kinds, counts = "stretch int, counts binary", np.zeros((STRETCHES, SLOTS // STRETCHES), np.uint32)
    for k, z in texts.select("text", "key").mapInArrow(run, kinds).repartition("stretch").mapInArrow(add, kinds).collect():
        counts[k] = np.minimum(np.frombuffer(zstandard.decompress(z), np.int64), (1 << 32) - 1)
    return np.where(counts < OFTEN, 0, counts).astype(np.uint32).ravel()


#: A text in the listing of a map task: its number there, key, size of its set, fingerprint, least shingle.
_TEXT = np.dtype([("ref", "<u4"), ("key", "<i8"), ("n", "<u4"), ("fp", "<u8"), ("least", "<u8")])


def _filed(texts: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(item, piece, pieces, key, n, fp, place): each distinct text under those prefix shingles that another text has as well.
    And (key, least) of every text with words, as often as map tasks have it.
    A shingle that over ``SHARD_CAP`` listings share is in several pieces; a piece lies in one partition, sorted.

    What is shuffled at first is a shingle, a text's number in its task and the shingle's place in the text's order, 14
    bytes, in arrays by shard of the shingles; sizes and fingerprints are sent once for each text and joined to the shared shingles alone.
    """
    spark = texts.sparkSession
    sent, shards = spark.sparkContext.broadcast(_counts(texts, words)), 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def handed(part, items, refs, places, listed):
        item, own, place = np.concatenate(items), np.concatenate(refs), np.concatenate(places)
        shard = (item % np.uint64(shards)).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        bounds = [0, *(np.flatnonzero(np.diff(shard[order])) + 1).tolist(), len(order)]
        rows = [(int(shard[order[a]]), item[order[a:b]].tobytes(), own[order[a:b]].tobytes(), place[order[a:b]].tobytes(), None) for a, b in zip(bounds, bounds[1:])]
        shard, *blobs = zip(*rows, (part % shards, None, None, None, np.array(listed, _TEXT).tobytes()))
        arrays = [pa.array(shard, pa.int32()), pa.array([part] * len(shard), pa.int64()), *[pa.array(x, pa.binary()) for x in blobs]]
        return pa.RecordBatch.from_arrays(arrays, names=["shard", "part", "items", "refs", "places", "texts"])

    @tidy
    def file(batches):
        counts = sent.value
        part, ref, items, refs, places, listed, waiting, met = TaskContext.get().partitionId(), 0, [], [], [], [], 0, set()
        for batch in batches:
            for t, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key in met:
                    continue
                met.add(key)
                s = np.unique(hashes(t, words))
                if not len(s):
                    continue
                listed.append((ref, key, len(s), majority(s), s[0]))
                s = s[np.argsort(counts[_slot(s)], kind="stable")]
                some = s[: len(s) - need(len(s), percent) + 1]
                items.append(some)
                refs.append(np.full(len(some), ref, "<u4"))
                places.append(np.minimum(np.arange(len(some)), 65535).astype("<u2"))
                ref, waiting = ref + 1, waiting + len(some)
                if waiting >= FILED:
                    yield handed(part, items, refs, places, listed)
                    items, refs, places, listed, waiting = [], [], [], [], 0
        if listed:
            yield handed(part, items, refs, places, listed)

    names = ["item", "ref", "place", "key", "n", "fp", "least"]

    def shared_of(items, refs, places):
        item, ref, place = np.concatenate(items), np.concatenate(refs), np.concatenate(places)
        order = np.argsort(item, kind="stable")
        item, ref, place = item[order], ref[order], place[order]
        same = item[1:] == item[:-1]
        more = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        return pa.RecordBatch.from_arrays([pa.array(item[more].view(np.int64)), pa.array(ref[more]), pa.array(place[more].astype(np.int32)), *[pa.nulls(int(more.sum()), pa.int64())] * 4], names=names)

    @tidy
    def shared(batches):
        last, items, refs, places = None, [], [], []
        for batch in batches:
            for shard, part, item, ref, place, texts_ in zip(*[c.to_pylist() for c in batch.columns]):
                if texts_ is not None:
                    x = np.frombuffer(texts_, _TEXT)
                    columns = [x["key"].astype(np.int64), x["n"].astype(np.int64), *(x[c].astype(np.uint64).view(np.int64) for c in ("fp", "least"))]
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(x), pa.int64()), pa.array(x["ref"].astype(np.int64) | part << 32), pa.nulls(len(x), pa.int32()), *map(pa.array, columns)], names=names)
                    continue
                if shard != last and items:
                    yield shared_of(items, refs, places)
                    items, refs, places = [], [], []
                last = shard
                items.append(np.frombuffer(item, "<u8"))
                refs.append(np.frombuffer(ref, "<u4").astype(np.int64) | part << 32)
                places.append(np.frombuffer(place, "<u2"))
        if items:
            yield shared_of(items, refs, places)

    handed_out = texts.select("text", "key").mapInArrow(file, "shard int, part long, items binary, refs binary, places binary, texts binary")
    found = cut(handed_out.repartition("shard").sortWithinPartitions("shard").mapInArrow(shared, "item long, ref long, place int, key long, n long, fp long, least long"))
    posted, listed = found.where("item IS NOT NULL").select("item", "ref", "place"), found.where("item IS NULL").select("ref", "key", "n", "fp")
    hot = cut(posted.groupBy("item").count().where(F.col("count") > SHARD_CAP).select("item", F.ceil(F.col("count") / SHARD_CAP).cast("int").alias("pieces")))
    rows = posted.join(listed, "ref").drop("ref").join(F.broadcast(hot) if hot.count() <= SENT else hot, "item", "left")
    rows = rows.withColumn("pieces", F.coalesce("pieces", F.lit(1))).withColumn("piece", F.pmod(F.xxhash64("key"), F.col("pieces")).cast("int"))
    return cut(rows.repartition("item", "piece").dropDuplicates(["item", "piece", "key"]).sortWithinPartitions("item", "piece").select("item", "piece", "pieces", "key", "n", "fp", "place")), found.where("item IS NULL").select("key", "least")


def _may_link(n, place, other_n, other_place, percent: int):
    """Whether texts with sets of these sizes can be similar, and have the shingle in their prefixes for the overlap that it takes.

    An overlap of ``o`` is found under one of the first ``n - o + 1`` shingles of both.
    """
    overlap = -(-percent * (n + other_n) // (100 + percent))
    return (100 * np.minimum(n, other_n) >= percent * np.maximum(n, other_n)) & (place <= n - overlap) & (other_place <= other_n - overlap)


def _handed_pairs(found):
    pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*found)], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _first_pairs(filed: DataFrame, percent: int, radius: int) -> DataFrame:
    """Pairs (a < b) of a text and one of ``FIRST`` texts of the same shingle.

    Half of these have the fingerprints nearest to the majority of the shingle's, as the text that others were made from
    has; the rest lie at even ranks of the distance to it. A shingle in several pieces has ``FIRST`` more that are drawn by hash
    and meet the texts of all its pieces in a join.
    """

    @tidy
    def run(batches):
        for table in _whole_groups(batches, 2):
            item, piece, _, key, n, fp, place = (c.to_numpy() for c in table.columns)
            fp = fp.view(np.uint64)
            start = np.concatenate(([0], np.flatnonzero((item[1:] != item[:-1]) | (piece[1:] != piece[:-1])) + 1))
            size = np.diff(np.append(start, len(item)))
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
            middle = np.packbits(2 * np.add.reduceat(bits, start) > size[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
            run_of = np.repeat(np.arange(len(start)), size)
            by = np.lexsort((key, np.bitwise_count(fp ^ middle[run_of]), run_of))
            key, n, fp, place = key[by], n[by], fp[by], place[by]
            out = []
            for i in range(FIRST):
                own = np.repeat(start + (np.minimum(i, size - 1) if 2 * i < FIRST else i * size // FIRST), size)
                ok = (key != key[own]) & (np.bitwise_count(fp ^ fp[own]) <= radius) & _may_link(n, place, n[own], place[own], percent)
                out.append((np.minimum(key, key[own])[ok], np.maximum(key, key[own])[ok]))
            yield _handed_pairs(out)

    some = [F.min(F.struct(F.xxhash64(F.lit(i), "key").alias("draw"), "key", "n", "fp")).alias(f"p{i}") for i in range(FIRST)]
    many = filed.where("pieces > 1")
    drawn = many.groupBy("item").agg(*some).select("item", F.array_distinct(F.array(*[f"p{i}" for i in range(FIRST)])).alias("ps"))
    met = many.join(drawn, "item").select("key", "n", "fp", F.explode("ps").alias("p")).where("key <> p.key")
    met = met.where((F.bit_count(F.col("fp").bitwiseXOR(F.col("p.fp"))) <= radius) & (100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n")))
    return filed.mapInArrow(run, "a long, b long").union(met.select(F.least("key", "p.key"), F.greatest("key", "p.key"))).distinct()


def _rest(filed: DataFrame, percent: int, radius: int) -> DataFrame:
    """All pairs (a < b) of texts under one shingle that bear different labels and may be similar enough.

    Shingles whose texts are linked already are left out. Of one in several pieces, every two pieces meet.
    """
    many = filed.where("pieces > 1")
    open_ = many.groupBy("item").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("item")
    many = many.join(open_, "item").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    many = many.select("item", F.least("piece", "other").alias("tree"), F.greatest("piece", "other").alias("members"), (F.col("piece") <= F.col("other")).alias("in_tree"), "key", "n", "fp", "label", "place")
    rows = filed.where("pieces = 1").select("item", F.lit(0).alias("tree"), F.lit(0).alias("members"), F.lit(True).alias("in_tree"), "key", "n", "fp", "label", "place").union(many)

    @tidy
    def run(batches):
        out, waiting = [], 0
        for table in _whole_groups(batches, 3):
            item, tree, members, in_tree, key, n, fp, label, place = (c.to_numpy() for c in table.columns)
            fp = fp.view(np.uint64)
            start = np.concatenate(([0], np.flatnonzero((item[1:] != item[:-1]) | (tree[1:] != tree[:-1]) | (members[1:] != members[:-1])) + 1))
            end = np.append(start[1:], len(item))
            open_ = np.minimum.reduceat(label, start) != np.maximum.reduceat(label, start)
            for a, b in zip(start[open_].tolist(), end[open_].tolist()):
                alone = tree[a] == members[a]
                trees, queries = (np.arange(a, b),) * 2 if alone else (np.flatnonzero(in_tree[a:b]) + a, np.flatnonzero(~in_tree[a:b]) + a)
                if len(trees) <= LEAF or radius >= 64:
                    q, v = np.nonzero(np.bitwise_count(fp[queries][:, None] ^ fp[trees][None, :]) <= radius)
                else:
                    q, v = BKTree(fp[trees]).search(fp[queries], radius)
                q, v = queries[q], trees[v]
                ok = (label[q] != label[v]) & _may_link(n[q], place[q], n[v], place[v], percent)
                if alone:
                    ok &= key[q] < key[v]
                q, v = key[q[ok]], key[v[ok]]
                out.append((np.minimum(q, v), np.maximum(q, v)))
                waiting += len(q)
                if waiting >= FILED:
                    yield _handed_pairs(out)
                    out, waiting = [], 0
        if out:
            yield _handed_pairs(out)

    by = ["item", "tree", "members"]
    return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a long, b long").distinct()


def _whole_groups(batches, by: int):
    """The rows of sorted batches in tables that end where one of the first ``by`` columns changes."""
    left, head = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        heads = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(by)], 1)
        if left and (heads[0] != head).any():
            yield pa.Table.from_batches(left).combine_chunks()
            left = []
        others = np.flatnonzero((heads != heads[-1]).any(1))
        end = int(others[-1]) + 1 if len(others) else 0
        if end:
            yield pa.Table.from_batches([*left, batch.slice(0, end)]).combine_chunks()
            left = []
        left.append(batch.slice(end))
        head = heads[-1]
    if left:
        yield pa.Table.from_batches(left).combine_chunks()


def _similar(pairs: DataFrame, texts: DataFrame, least: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar.

    The first texts of the pairs are gathered in blocks of about ``BLOCK`` by their least shingle, which texts of a
    group mostly share; every other text comes once to each block in which it has partners, not once for each
    pair. A block that many come to is sent to several tasks. Texts are looked up by broadcast keys if these are
    few, else by a join.
    """
    first = pairs.select(F.col("a").alias("key")).distinct().join(least, "key").dropDuplicates(["key"])
    sizes = first.groupBy("least").count().where(F.col("count") > BLOCK).select("least", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    block = F.struct("least", F.pmod(F.xxhash64("key"), F.coalesce("parts", F.lit(1))).alias("part")).alias("block")
    first = cut(first.join(sizes, "least", "left").select("key", block))
    met = cut(pairs.join(first.withColumnRenamed("key", "a"), "a").groupBy("block", F.col("b").alias("key")).agg(F.collect_list("a").alias("partners")))
    many = met.groupBy("block").count().where(F.col("count") > COME).select("block", F.ceil(F.col("count") / COME).cast("int").alias("tasks"))
    come = met.join(many, "block", "left").select("block", F.pmod(F.xxhash64("key"), F.coalesce("tasks", F.lit(1))).cast("int").alias("task"), F.lit(1).alias("kind"), "key", "partners")
    stay = first.join(many, "block", "left").select("block", F.explode(F.sequence(F.lit(0), F.coalesce("tasks", F.lit(1)) - 1)).alias("task"), F.lit(0).alias("kind"), "key", F.lit(None).cast("array<long>").alias("partners"))
    rows = come.union(stay)
    wanted = cut(rows.select("key").distinct())
    known = texts.join(F.broadcast(wanted) if wanted.count() <= SENT else wanted, "key", "left_semi").dropDuplicates(["key"])

    @tidy
    def run(batches):
        last, own = None, {}
        for batch in batches:
            found = []
            for least_, part, task, kind, key, partners, text in zip(*[c.to_pylist() for c in batch.columns]):
                if (least_, part, task) != last:
                    last, own = (least_, part, task), {}
                s = np.unique(hashes(text, words))
                if not kind:
                    own[key] = s
                    continue
                for a in partners:
                    both = len(np.intersect1d(own[a], s, assume_unique=True))
                    if 100 * both >= percent * (len(own[a]) + len(s) - both):
                        found.append((a, key))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    by = ["least", "part", "task"]
    rows = rows.join(known, "key").select("block.least", "block.part", "task", "kind", "key", "partners", "text")
    return rows.repartition(*by).sortWithinPartitions(*by, "kind").mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, text_col: str = "text", words: int = 5, percent: int = 80, radius: int = WIDE) -> DataFrame:
    """(key, label) of the texts that have a near copy; ``key`` is XXH64 of the text, ``label`` that of its group.

    Texts whose sets of ``words``-word shingles have a Jaccard similarity of ``percent`` or more are linked, and
    groups are what links join. Every pair is considered, unless a ``radius`` below 64 leaves out those whose
    fingerprints (of the distinct shingles) differ in more bits. Null and wordless
    texts have no near copy; a text shorter than ``words`` is one shingle; repeated texts are one; an empty
    table gives an empty one; long texts are compared as a whole. Other columns are not read.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").withColumn("key", F.xxhash64("text"))
    filed, least = _filed(texts, words, percent)
    first = cut(_first_pairs(filed, percent, radius))
    links = cut(_similar(first, texts, least, words, percent))
    label = components(links).withColumnRenamed("label", "_label")
    label = cut(label.withColumnRenamed("id", "key"))
    filed = filed.join(F.broadcast(label) if label.count() <= SENT else label, "key", "left").withColumn("label", F.coalesce("_label", "key")).drop("_label")
    rest = cut(_rest(filed, percent, radius).join(first, ["a", "b"], "left_anti"))
    return components(links.union(_similar(rest, texts, least, words, percent))).withColumnRenamed("id", "key")
