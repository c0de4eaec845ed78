"""Mixing sources to target weights by subset-sum budget fitting.

Each source's words are counted by exact document length. A target beyond the source's words repeats
the whole source; what is left of the budget is first spread evenly over the lengths, then closed by
larger lengths while it is wide, and at last fitted exactly by a bounded-knapsack dynamic programme
over the lengths still unused; few long documents are fitted by it as a whole. The plan says how many documents of each length to take; a seeded
rank within (source, length) names them. Every source is planned in its own task from its histogram;
the driver sees one row per source.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ranked

WEIGHTS = (5, 2, 1)
#: Budget that the dynamic programme fits, in words; a wider rest is narrowed first, as far as lengths allow.
FIT = 1 << 13
#: Bytes of states up to which a source whose rest stays open is fitted as a whole.
WIDE = 1 << 26
#: The words that count towards a size.
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: float = 3.0) -> dict:
    """Targets that share all words by weight; none above ``most`` times its source, the excess reshared."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, total = dict(order), float(sum(n for _, n in order))
    out, free, left = {}, [s for s, _ in order], total
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > most * size[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = most * size[s]
            left -= out[s]
        free = [s for s in free if s not in above]
    return out


def knapsack(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take so that their sum is as near ``budget`` as can be, below in a tie.

    Reachable sums are the bits of one integer; a count is split in powers of two, and the states after
    each part lead back to the choice. A sum beyond twice the budget is never nearer than nothing.
    """
    mask, state = (1 << (2 * budget + 1)) - 1, 1
    parts, states = [], []
    for i, (length, count) in enumerate(zip(lengths, counts)):
        count, step = min(count, 2 * budget // length), 1
        while count > 0 and not state >> budget & 1:
            step = min(step, count)
            parts.append((i, step, length * step))
            states.append(state)
            state = (state | state << (length * step)) & mask
            count, step = count - step, step * 2
    below = (state & ((1 << (budget + 1)) - 1)).bit_length() - 1
    more = state >> (budget + 1)
    above = budget + (more & -more).bit_length() if more else 3 * budget + 1
    at, taken = below if budget - below <= above - budget else above, [0] * len(lengths)
    for (i, step, total), before in zip(reversed(parts), reversed(states)):
        if not before >> at & 1:
            taken[i] += step
            at -= total
    return taken


def exchange(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: int) -> np.ndarray:
    """``take`` with one document exchanged for another as long as that brings the sum nearer to ``budget``."""
    take = take.copy()
    while miss := budget - int((lengths * take).sum()):
        own, free = np.flatnonzero(take), np.flatnonzero(counts > take)
        if not len(own) or not len(free):
            break
        at = np.searchsorted(lengths[free], lengths[own] + miss)
        by = np.concatenate([free[np.maximum(at - 1, 0)], free[np.minimum(at, len(free) - 1)]])
        own = np.concatenate([own, own])
        left = np.abs(miss - (lengths[by] - lengths[own]))
        i = int(left.argmin())
        if left[i] >= abs(miss):
            break
        take[own[i]] -= 1
        take[by[i]] += 1
    return take


def plan(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents to take of each length (ascending, positive) for a sum as close to ``budget`` as can be."""
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return counts.copy()
    take = np.zeros(len(lengths), np.int64)
    if budget > FIT:
        take = np.array([int(c) * budget // total for c in counts], np.int64)
    rest = budget - int((lengths * take).sum())
    for i in range(len(lengths) - 1, -1, -1):
        if rest <= FIT:
            break
        more = min(int(counts[i] - take[i]), (rest - FIT // 2) // int(lengths[i]))
        if more > 0:
            take[i] += more
            rest -= more * int(lengths[i])
    fits = np.flatnonzero((lengths <= 2 * rest) & (counts > take))[::-1]
    if rest > FIT + FIT // 2:
        # Every length left is above rest - FIT / 2: two documents are never nearer than one.
        miss = np.abs(lengths[fits] - rest)
        near = fits[(miss == miss.min(initial=rest)) & (miss < rest)]
        take[near[-1:]] += 1
    elif rest > 0:
        take[fits] += np.array(knapsack(lengths[fits].tolist(), (counts - take)[fits].tolist(), rest), np.int64)
    # Only long documents are left: exchange them, with the documents taken so far or one more.
    take = exchange(lengths, counts, take, budget)
    free = np.flatnonzero(counts > take)
    if budget != int((lengths * take).sum()) and len(free):
        more = take.copy()
        more[free[0]] += 1
        more = exchange(lengths, counts, more, budget)
        take = min(take, more, key=lambda x: abs(budget - int((lengths * x).sum())))
    # Few long documents: the even share may stand in the way of a nearer sum.
    miss = abs(budget - int((lengths * take).sum()))
    most = np.minimum(counts, 2 * budget // lengths)
    if miss and sum(int(c).bit_length() for c in most) * budget // 4 <= WIDE:
        whole = np.array(knapsack(lengths[::-1].tolist(), counts[::-1].tolist(), budget)[::-1], np.int64)
        if abs(budget - int((lengths * whole).sum())) < miss:
            return whole
    return take


def words(text_col: str = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42, weights=WEIGHTS, most: int = 3, keep: list[str] | None = None, size_col: str | None = None) -> DataFrame:
    """(id, source, size, source_size, target, taken, ``keep``) of every row.

    ``taken`` is the words that the mix takes of the row, repeats counted: a multiple of its size, at
    most ``most`` times it. Null and empty texts have size 0 and take nothing; a null source is a source
    of its own, sorted last; rows that repeat, or whose ids tie, are chosen in the order of the hash and
    the id, and equal rows are interchangeable; an empty table gives an empty one. Only the columns named
    are read; ``size_col``, if given, holds sizes that are already counted. Sources are few: the driver holds one row for each.
    """
    keep = keep or []
    sized = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        (F.col(size_col) if size_col else words(text_col)).alias("size"),
        *[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)],
    ).withColumn("draw", F.xxhash64(F.lit(seed), "id"))
    rows = ranked(cut(sized), ["source", "size"], ["draw", "id"])  # words are counted once: dealing rows out reads them twice
    counted = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sums = [(r["source"], r["words"]) for r in rows.groupBy("source").agg(F.sum("size").alias("words")).collect()]
    goal, size = targets(sums, weights, most), dict(sums)

    def run(frame):
        frame = frame[frame["size"] > 0].sort_values("size")
        source = None if not len(frame) or pd.isna(frame["source"].iloc[0]) else frame["source"].iloc[0]
        if not len(frame):
            return pd.DataFrame({"p_source": [], "p_size": [], "whole": [], "some": []})
        words = size[source]
        whole = min(most, int(round(goal[source]) // words))
        take = plan(frame["size"].to_numpy(), frame["n"].to_numpy(), 0 if whole == most else int(round(goal[source])) - whole * words)
        return pd.DataFrame({"p_source": [source] * len(frame), "p_size": frame["size"], "whole": whole, "some": take})

    planned = counted.groupBy("source").applyInPandas(run, "p_source string, p_size long, whole long, some long")
    known = rows.join(planned, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")), "left")
    by = F.create_map(*[x for s, t in goal.items() for x in (F.lit(f"s{s}" if s is not None else "null"), F.struct(F.lit(int(size[s])).cast("long").alias("n"), F.lit(float(t)).alias("t")))]) if goal else F.lit(None).cast("map<string,struct<n:long,t:double>>")
    own = by[F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("s"), "source"))]
    taken = F.coalesce(F.col("size") * (F.col("whole") + F.when(F.col("rank") < F.col("some"), 1).otherwise(0)), F.lit(0)).cast("long")
    return known.select(F.col("id").alias(id_col), "source", "size", own["n"].alias("source_size"), own["t"].alias("target"), taken.alias("taken"), *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)])
