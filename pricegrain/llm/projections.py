"""Approximate nearest neighbours by low-dimensional stable projections and kd-trees.

All vectors are projected on a few Gaussian directions. For unit vectors at distance s, the squared
projected distance divided by s squared is chi-squared distributed with as many degrees of freedom.
Each shard indexes its projections by a kd-tree, which yields a query's neighbours one after the other by projected
distance; each is verified against the original vectors. A query stops once the next projected neighbour is so far
that a vector as near as the k-th best so far would have shown up before with probability ``confidence``. There is
no cap on candidates: without a stop, the whole shard is verified.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .covertree import opened, packed, unit, vectors
from .secrets import chi2_tail

#: Rows of an index shard, queries of a block, projections of a leaf, leaves opened and vectors verified at once.
SHARD, QUERIES, LEAF, OPEN, STEP = 8192, 1024, 64, 4, 64


#: Vector lengths that are broadcast at most.
FEW = 1 << 16


def quantile(dims: int, confidence: float) -> float:
    """Chi-squared quantile by bisection."""
    low, high = 0.0, 10.0 * dims + 100
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - chi2_tail(mid, dims) < confidence else (low, mid)
    return high


def directions(size: int, dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, dims))


class KDTree:
    """Leaves of a kd-tree by median splits on the widest side: order of the points, bounds, boxes."""

    def __init__(self, p: np.ndarray):
        leaves, waiting = [], [np.arange(len(p))]
        while waiting:
            some = waiting.pop()
            if len(some) <= LEAF:
                leaves.append(some)
                continue
            axis = int(np.ptp(p[some], axis=0).argmax())
            some = some[np.argsort(p[some, axis], kind="stable")]
            waiting += [some[: len(some) // 2], some[len(some) // 2 :]]
        self.leaves, self.points = leaves, p
        self.low = np.array([p[x].min(0) for x in leaves])
        self.high = np.array([p[x].max(0) for x in leaves])

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of a query to every leaf's box."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        return (gap * gap).sum(1)


def nearest(ids: np.ndarray, raw: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, dims: int, confidence: float, seed: int):
    """(query id, id, cosine, vectors verified) of the nearest found of a shard to each query, its own id left out."""
    way = directions(raw.shape[1], dims, seed)
    x, q = unit(raw), unit(queries)
    norm, query_norm = np.sqrt((raw * raw).sum(1)), np.sqrt((queries * queries).sum(1))
    tree, stop = KDTree(x @ way), quantile(dims, confidence)
    projected = q @ way
    for i in range(len(q)):
        bound = tree.bounds(projected[i])
        order = np.argsort(bound, kind="stable")
        seen, cosines, at = [np.zeros(0, np.int64)], [np.zeros(0)], 0
        waiting, far, best, limit = np.zeros(0, np.int64), np.zeros(0), np.zeros(0), math.inf
        while True:
            beyond = bound[order[at]] if at < len(order) else math.inf
            ready = np.searchsorted(far, min(beyond, limit), "right")  # nearer than anything in leaves not opened yet
            if ready:
                some, waiting, far = waiting[: min(ready, STEP)], waiting[min(ready, STEP) :], far[min(ready, STEP) :]
                seen.append(some)
                cosines.append(x[some] @ q[i])
                best = np.concatenate([best, cosines[-1]])
                if len(best) >= k:
                    best = np.partition(best, len(best) - k)[len(best) - k :]  # the rest can't be among the k best
                    limit = stop * max(0.0, 2 - 2 * best.min()) + 1e-9
                continue
            if at >= len(order) or beyond > limit:
                break
            some = np.concatenate([tree.leaves[j] for j in order[at : at + OPEN]])
            at += OPEN
            some = some[ids[some] != query_ids[i]]
            gap = tree.points[some] - projected[i]
            waiting, far = np.concatenate([waiting, some]), np.concatenate([far, (gap * gap).sum(1)])
            by = np.argsort(far, kind="stable")
            waiting, far = waiting[by], far[by]
        some, near = np.concatenate(seen), np.concatenate(cosines)
        verified = len(some)
        if len(some) > k:
            some = some[near >= np.partition(near, len(near) - k)[len(near) - k] - 1e-9]
        score = (raw[some] * queries[i]).sum(1) / (norm[some] * query_norm[i])
        for j in np.lexsort((ids[some], -score))[:k]:
            yield int(query_ids[i]), int(ids[some[j]]), float(score[j]), verified


def search(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = 5, dims: int = 16, confidence: float = 0.98, seed: int = 42) -> DataFrame:
    """(query_id, rank, vec_id, score, verified): the ``k`` nearest found of each row whose id is divisible by ``every``.

    Nearness is the cosine of the original vectors in double precision, ties go to the smaller id. All
    rows are indexed. Vectors that are null, empty, zero or hold null or non-finite parts take no part,
    nor do rows with null ids; repeated rows count once; vectors of several lengths are searched among
    their own length, of which there may be any number; an empty table gives an empty one; other columns are
    ignored. ``verified`` is how many vectors of the neighbour's shard the query was verified against.
    """
    rows = cut(vectors(df, id_col, vec_col).where("raw IS NOT NULL AND id IS NOT NULL").select(F.col("id").cast("long").alias("id"), "raw").distinct().withColumn("size", F.length("raw")))
    ask = F.pmod("id", F.lit(every)) == 0
    parts = lambda n, each: F.greatest(F.ceil(n / each), F.lit(1)).cast("int")
    sizes = cut(rows.groupBy("size").agg(parts(F.count(F.lit(1)), SHARD).alias("shards"), parts(F.count_if(ask), QUERIES).alias("blocks")))
    rows = rows.join(F.broadcast(sizes) if sizes.count() <= FEW else sizes, "size")

    def blob(kind):
        def run(frame):
            frame = frame.sort_values("id")
            if kind == "index":  # of equal vectors, no more than k + 1 can be among a query's k nearest
                frame = frame[frame.groupby("raw").cumcount() <= k]
            return pd.DataFrame({**{c: [frame[c].iloc[0]] for c in ("size", "part", "other")}, "ids": [frame["id"].to_numpy(np.int64).tobytes()], "raw": [packed(frame["raw"].tolist())]})

        return run

    shape = "size int, part int, other int, ids binary, raw binary"
    part = lambda n, other: [F.pmod(F.xxhash64("id"), F.col(n).cast("long")).cast("int").alias("part"), F.col(other).alias("other")]
    shards = rows.select("id", "raw", "size", *part("shards", "blocks")).groupBy("size", "part").applyInPandas(blob("index"), shape)
    asked = rows.where(ask).select("id", "raw", "size", *part("blocks", "shards")).groupBy("size", "part").applyInPandas(blob("query"), shape)
    each = F.explode(F.sequence(F.lit(0), F.col("other") - 1))
    grid = shards.select("size", F.col("part").alias("shard"), each.alias("block"), F.lit(False).alias("asks"), "ids", "raw")
    grid = grid.union(asked.select("size", each.alias("shard"), F.col("part").alias("block"), F.lit(True).alias("asks"), "ids", "raw"))

    def meet(frame):
        found = []
        if len(frame) == 2:
            (ids, raw), (query_ids, queries) = ((i := np.frombuffer(r["ids"], np.int64), opened(r["raw"], len(i))) for _, r in frame.sort_values("asks").iterrows())
            found = list(nearest(ids, raw, query_ids, queries, k, dims, confidence, seed))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score", "verified"]).astype({"query_id": "int64", "vec_id": "int64", "score": float, "verified": "int64"})

    best = grid.groupBy("size", "shard", "block").applyInPandas(meet, "query_id long, vec_id long, score double, verified long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "verified")
