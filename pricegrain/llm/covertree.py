"""Embedding near-duplicates: exact cosine-threshold pairs by dual traversal of cover trees.

Distances are angles, a metric on directions. The top level of the tree is a net over a bounded sample,
taken by halving radii; every vector joins its nearest centre, and a cell is dealt into blocks of a
bounded size by a hash. A block builds its own nested levels with halving radii and true covering radii.
Node pairs whose centres are further apart than both radii and the threshold angle are pruned, from
whole cells down to single vectors; a pair that lies within the threshold as a whole is counted without
being opened, so that a tight group of any size costs a node pair and never its square. Leaves compare
cosines in double precision. Tasks report counts of links per vector and one link per pair of linked
groups, not the pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, local_components, mapped

#: Vectors sampled for the top level, most cells, and mean vectors of a block.
SAMPLE, CELLS, BLOCK = 4096, 512, 2048
#: Blocks that are sent together.
BUNDLE = 4
#: Rounding allowance of angles, in radians; decisions within it are left to the cosines.
SLACK = 1e-6


def valid_vector(v) -> np.ndarray | None:
    """A vector in double precision, or None if it is null, empty, zero or has null or non-finite parts."""
    if not v or None in v:
        return None
    x = np.array(v, np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=-1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=-1, keepdims=True))


def angles(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1.0, 1.0))


def packed(raws: list[bytes]) -> bytes:
    """Vectors given as doubles in one string: in single precision if that is exact."""
    x = np.frombuffer(b"".join(raws))
    with np.errstate(over="ignore"):
        small = x.astype(np.float32)
    return b"f" + small.tobytes() if np.array_equal(small, x) else b"d" + x.tobytes()


def opened(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, np.float32 if blob[:1] == b"f" else np.float64, offset=1).astype(np.float64).reshape(n, -1)


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, digest, raw): raw holds the doubles of a valid vector; both are null for the others."""

    def run(values):
        digests, raws = [], []
        for v in values:
            x = valid_vector(v)
            raw = None if x is None else (x + 0.0).tobytes()
            raws.append(raw)
            digests.append(None if raw is None else hashlib.blake2b(raw, digest_size=16).digest())
        return digests, raws

    return mapped(df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")), ["id"], ["v"], "digest binary, raw binary", run)


def net(x: np.ndarray, most: int) -> np.ndarray:
    """Indexes of up to ``most`` centres: nested nets of ``x`` at halving radii, coarsest first."""
    chosen, near, radius = [0], angles(x @ x[0]), math.pi / 2
    while len(chosen) < min(most, len(x)) and radius > 1e-3:
        for i in range(len(x)):
            if near[i] > radius:
                chosen.append(i)
                near = np.minimum(near, angles(x @ x[i]))
                if len(chosen) == most:
                    break
        radius /= 2
    return np.array(chosen)


class Tree:
    """Nested levels over unit vectors: level l has radius pi / 2**(l+1), every centre stays one below.

    ``centre[l]`` are the nodes' vectors, ``node[l]`` the node of each vector, ``radius[l]`` the true
    covering radii, ``parent[l]`` each node's node one level up. The last level is the vectors themselves.
    """

    def __init__(self, x: np.ndarray, floor: float = 0.02):
        m = len(x)
        self.centre, self.node, self.radius, self.parent = [], [], [], []
        above, radius = np.zeros(m, np.int64), math.pi / 2
        tops = np.zeros(1, np.int64) if m else np.zeros(0, np.int64)
        while m:
            own, centres, parents = np.full(m, -1), [], []
            for k, top in enumerate(tops.tolist()):
                members = np.flatnonzero(above == k)
                members = np.concatenate(([top], members[members != top]))
                while len(members):
                    c = members[0]
                    inside = angles(x[members] @ x[c]) <= radius
                    inside[0] = True
                    own[members[inside]] = len(centres)
                    centres.append(int(c))
                    parents.append(k)
                    members = members[~inside]
            self._add(x, np.array(centres), own, np.array(parents))
            if len(centres) == m:
                break
            if radius < floor:
                self._add(x, np.arange(m), np.arange(m), own)
                break
            tops, above, radius = np.array(centres), own, radius / 2

    def _add(self, x, centre, node, parent):
        far = np.zeros(len(centre))
        np.maximum.at(far, node, np.where(centre[node] == np.arange(len(x)), 0.0, angles((x * x[centre[node]]).sum(1))))
        self.centre.append(centre)
        self.node.append(node)
        self.radius.append(far)
        self.parent.append(parent)


def dual(x: np.ndarray, a: Tree, y: np.ndarray, b: Tree, threshold: float):
    """Links of the vectors of two trees with cosine >= threshold: per level, pairs of nodes linked as a whole.

    Yields (level of a, nodes of a, level of b, nodes of b); leaf pairs come from the last levels.
    """
    limit = math.acos(threshold)
    la = lb = 0
    live = np.ones((len(a.centre[0]), len(b.centre[0])), bool) if a.centre and b.centre else np.zeros((0, 0), bool)
    while live.any():
        rows, columns = np.flatnonzero(live.any(1)), np.flatnonzero(live.any(0))
        last = la == len(a.centre) - 1 and lb == len(b.centre) - 1
        step = max(1, (1 << 20) // max(1, len(columns)))
        for i in range(0, len(rows), step):
            r = rows[i : i + step]
            cos = x[a.centre[la][r]] @ y[b.centre[lb][columns]].T
            part = live[np.ix_(r, columns)]
            if last:
                hit = part & (cos >= threshold)
                part[:] = False
            else:
                apart, reach = angles(cos), a.radius[la][r][:, None] + b.radius[lb][columns][None, :]
                hit = part & (apart + reach <= limit - SLACK)
                part &= (apart <= reach + limit + SLACK) & ~hit
            p, q = np.nonzero(hit)
            if len(p):
                yield la, r[p], lb, columns[q]
            live[np.ix_(r, columns)] = part
        if last:
            return
        down_a, down_b = la < len(a.centre) - 1, lb < len(b.centre) - 1
        live = live[a.parent[la + 1]] if down_a else live
        live = live[:, b.parent[lb + 1]] if down_b else live
        la, lb = la + down_a, lb + down_b


def tally(links, a: Tree, weight_a, b: Tree, weight_b, itself: bool = False):
    """Weights linked to each vector of a and of b, and links (vector of a, vector of b) that connect the same groups."""
    count_a, count_b = np.zeros(len(weight_a), np.int64), np.zeros(len(weight_b), np.int64)
    ends_a, ends_b = [], []
    for la, p, lb, q in links:
        for count, tree, level, own, other, other_level, theirs, weight in ((count_a, a, la, p, b, lb, q, weight_b), (count_b, b, lb, q, a, la, p, weight_a)):
            node_weight = np.bincount(other.node[other_level], weight, len(other.centre[other_level])).astype(np.int64)
            gain = np.bincount(own, node_weight[theirs], len(tree.centre[level])).astype(np.int64)
            count += gain[tree.node[level]]
        ends_a.append(a.centre[la][p])
        ends_b.append(b.centre[lb][q])
        for tree, level, own, other, other_level, theirs, mine, other_ends in ((a, la, p, b, lb, q, ends_a, ends_b), (b, lb, q, a, la, p, ends_b, ends_a)):
            partner = np.full(len(tree.centre[level]), -1)
            partner[own] = other.centre[other_level][theirs]
            to = partner[tree.node[level]]
            inside = np.flatnonzero(to >= 0)
            mine.append(inside)
            other_ends.append(to[inside])
    join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    return count_a, count_b, join(ends_a), join(ends_b)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """(id, n_links, component_id, kept) of every row, by cosine >= ``threshold`` over all rows.

    Vectors that are null, empty, zero or hold null or non-finite parts link with nothing and are their
    own component; vectors are compared with those of their own length, of which there may be any number. Equal vectors
    are processed once and counted as often as they occur: a row that repeats links with its own copies.
    ``component_id`` is the smallest id reachable, and ``kept`` marks the row that has it. A null id comes back
    unlinked with ``kept`` true. An empty table gives an empty one; other columns are ignored.
    """
    every = vectors(df, id_col, vec_col)
    reps = cut(every.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("raw").alias("raw")))
    # Lengths with many vectors have a tree of their own, each block a task; all others are a block each.
    size = F.length("raw")
    sizes = [r["size"] for r in reps.groupBy(size.alias("size")).count().where(F.col("count") > 2 * BLOCK).collect()]
    few = reps.where(~size.isin(sizes)) if sizes else reps
    own = cut(few.select(size.alias("block"), F.lit(0).cast("long").alias("cell"), "rep", "weight", "raw").groupBy("block").applyInPandas(_block(threshold), SHAPE))
    counts, links = ([x] for x in _inside(own))
    for s in sizes:
        c, e = _links(reps.where(size == s), threshold)
        counts.append(c)
        links.append(e)
    for extra in counts[1:]:
        counts[0] = counts[0].union(extra)
    for extra in links[1:]:
        links[0] = links[0].union(extra)
    linked = counts[0].groupBy("rep").agg(F.sum("n").alias("n"))
    label = components(links[0]).select(F.col("id").alias("rep"), "label")
    known = reps.select("digest", "rep", "weight").join(linked, "rep", "left").join(label, "rep", "left")
    known = known.select("digest", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("label", "rep").alias("component_id"))
    out = every.select("id", "digest").join(known, "digest", "left")
    own = F.col("id").isNotNull() & F.col("component_id").isNotNull()
    component = F.when(own, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.when(own, F.col("n_links")).otherwise(0).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


SHAPE = "block int, cell int, ids binary, weight binary, raw binary, count binary, group binary, tree array<binary>"


def _block(threshold: float):
    """What makes a block's vectors one row: ids, vectors, tree, counts of inner links and inner groups."""

    def build(frame):
        frame = frame.sort_values("rep")
        x = unit(np.frombuffer(b"".join(frame["raw"])).reshape(len(frame), -1))
        weight, tree = frame["weight"].to_numpy(np.int64), Tree(x)
        # both orders of every pair, and each vector with itself, come up: take one side's counts
        count, _, p, q = tally(dual(x, tree, x, tree, threshold), tree, weight, tree, weight)
        with_itself = (x * x).sum(1) >= threshold
        group = local_components(len(x), p, q)
        parts = [[np.asarray(x, np.int32) for x in tree.centre], [np.asarray(x, np.int32) for x in tree.node], tree.radius, [np.asarray(x, np.int32) for x in tree.parent]]
        return pd.DataFrame({
            "block": [int(frame["block"].iloc[0])], "cell": [int(frame["cell"].iloc[0])],
            "ids": [frame["rep"].to_numpy(np.int64).tobytes()], "weight": [weight.tobytes()], "raw": [packed(frame["raw"].tolist())],
            "count": [(count - np.where(with_itself, weight, 0)).tobytes()], "group": [group.astype(np.int64).tobytes()],
            "tree": [[part.tobytes() for level in zip(*parts) for part in level]],
        })

    return build


def _inside(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rep, n) and (a, b) of the links within blocks."""

    def inside(frames):
        for frame in frames:
            for ids, count, group in zip(frame["ids"], frame["count"], frame["group"]):
                ids, count, group = (np.frombuffer(v, np.int64) for v in (ids, count, group))
                yield pd.DataFrame({"a": ids, "n": count, "b": ids[group]})

    own = blocks.select("ids", "count", "group").mapInPandas(inside, "a long, n long, b long")
    return own.select(F.col("a").alias("rep"), "n"), own.where("a <> b").select("a", "b")


def _links(reps: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(rep, n) link counts and (a, b) links that connect the same groups, of distinct vectors of one length."""
    n = reps.count()
    draw, share = F.xxhash64("rep"), min(1.0, 2.0 * SAMPLE / n)  # a share of the draws that holds twice the sample
    some = reps.where(draw < int(-(2.0**63) + share * 2.0**64)) if share < 1 else reps
    top = unit(np.stack([np.frombuffer(r["raw"]) for r in some.orderBy(draw).limit(SAMPLE).select("raw").collect()]))
    centres = top[net(top, max(1, min(CELLS, math.ceil(n / (2 * BLOCK)))))]

    def place(raws):
        x = unit(np.frombuffer(b"".join(raws)).reshape(len(raws), -1)) if raws else np.zeros((0, centres.shape[1]))
        cell, far = np.zeros(len(x), np.int64), np.zeros(len(x))
        for i in range(0, len(x), 4096):
            cos = x[i : i + 4096] @ centres.T
            cell[i : i + 4096] = cos.argmax(1)
            far[i : i + 4096] = angles(cos.max(1))
        return cell, far

    placed = cut(mapped(reps, ["rep", "weight", "raw"], ["raw"], "cell long, far double", place))
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect()}  # CELLS rows at most
    first, pieces, at = {}, {}, 0
    for k in sorted(cells):
        first[k], pieces[k] = at, max(1, round(cells[k]["n"] / BLOCK))
        at += pieces[k]
    limit = math.acos(threshold)
    close = angles(centres @ centres.T)
    partner = {k: [j for j in first if close[k, j] <= cells[k]["far"] + cells[j]["far"] + limit + SLACK or j == k] for k in first}
    mapping = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    block = (mapping(first)[F.col("cell")] + F.pmod(F.xxhash64("rep"), mapping(pieces)[F.col("cell")].cast("long"))).cast("int")
    blocks = cut(placed.withColumn("block", block).select("block", "cell", "rep", "weight", "raw").groupBy("block").applyInPandas(_block(threshold), SHAPE))
    # Blocks meet in bundles of ``BUNDLE``: a block is sent once to each bundle that holds a partner's block, not to each block.
    spark = reps.sparkSession
    pairs_of_cells = spark.createDataFrame([(k, first[j] // BUNDLE, (first[j] + pieces[j] - 1) // BUNDLE) for k, js in partner.items() for j in js], "cell int, low int, high int")  # CELLS squared at most
    own = (F.col("block") / BUNDLE).cast("int")
    sent = blocks.join(F.broadcast(pairs_of_cells), "cell").select("block", "ids", "weight", "raw", "group", "tree", F.explode(F.sequence("low", "high")).alias("other"))
    sent = sent.withColumn("low", F.least(own, "other")).withColumn("high", F.greatest(own, "other")).drop("other").dropDuplicates(["block", "low", "high"])

    def unpacked(row):
        ids = np.frombuffer(row["ids"], np.int64)
        tree = Tree(np.zeros((0, 1)))
        for i, part in enumerate(row["tree"]):
            (tree.centre, tree.node, tree.radius, tree.parent)[i % 4].append(np.frombuffer(part, np.float64 if i % 4 == 2 else np.int32))
        return ids, np.frombuffer(row["weight"], np.int64), unit(opened(row["raw"], len(ids))), np.frombuffer(row["group"], np.int64), tree

    def meet(left, right):
        (ids_a, weight_a, x, group_a, a), (ids_b, weight_b, y, group_b, b) = left, right
        count_a, count_b, p, q = tally(dual(x, a, y, b, threshold), a, weight_a, b, weight_b)
        pairs = np.unique(np.stack([group_a[p], group_b[q]], 1), axis=0) if len(p) else np.zeros((0, 2), np.int64)
        label = local_components(len(ids_a) + len(ids_b), pairs[:, 0], pairs[:, 1] + len(ids_a))
        ids = np.concatenate([ids_a, ids_b])
        moved, some_a, some_b = np.flatnonzero(label != np.arange(len(label))), np.flatnonzero(count_a), np.flatnonzero(count_b)
        return pd.DataFrame({
            "a": np.concatenate([ids[moved], ids_a[some_a], ids_b[some_b]]),
            "b": np.concatenate([ids[label[moved]], count_a[some_a], count_b[some_b]]),
            "link": np.arange(len(moved) + len(some_a) + len(some_b)) < len(moved),
        })

    def across(frame):
        """The blocks of two bundles, or of one with itself: every two blocks once."""
        alone = frame["low"].iloc[0] == frame["high"].iloc[0]
        rows = [(int(r["block"]), unpacked(r)) for _, r in frame.sort_values("block").iterrows()]
        found = [meet(x, y) for i, (p, x) in enumerate(rows) for q, y in rows[i + 1 :] if alone or p // BUNDLE != q // BUNDLE]
        return pd.concat(found) if found else pd.DataFrame({"a": [], "b": [], "link": []}).astype({"a": "int64", "b": "int64", "link": bool})

    pairs = cut(sent.groupBy("low", "high").applyInPandas(across, "a long, b long, link boolean"))

    counts, joined = _inside(blocks)
    return counts.union(pairs.where("NOT link").select("a", "b")), joined.union(pairs.where("link").select("a", "b"))
