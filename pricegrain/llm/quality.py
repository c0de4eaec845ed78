"""Quality classifier: a sparse ensemble of rules over text statistics.

Small randomized trees are grown on labelled rows; every path from a root is a conjunctive rule over the
statistics. A logistic model with a lasso penalty keeps few of the rules, and those compile into one
Spark column expression, so that scoring runs inside the JVM on the statistics of whole texts.

The ensemble is fitted on at most ``rows`` labelled rows, drawn by a hash of the id.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, cut, mapped

STATISTICS = ("words", "mean_word", "longest_word", "upper", "digits", "symbols", "wide", "marked_words", "lone_symbols", "capital_words", "repeated_words", "top_word", "repeated_lines", "mean_line", "ended_lines", "sentence_words")
_UPPER, _DIGIT, _SYMBOL, _WIDE, _LOWER = range(1, 6)
_CLASS = np.zeros(256, np.uint8)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = _WIDE if _b >= 128 else _UPPER if "A" <= _c <= "Z" else _LOWER if "a" <= _c <= "z" else _DIGIT if "0" <= _c <= "9" else 0 if _c in " \t\n\r\x0b\x0c" else _SYMBOL
_MARKED = re.compile(r"\w[^\w\s]{2,}(?:\s|$)")


def statistics(text: str | None) -> tuple[float, ...]:
    """The values named by STATISTICS, over the whole text; zeros for a text without words."""
    words = (text or "").split()
    if not words:
        return (0.0,) * len(STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.zeros(6, np.int64)
    for i in range(0, len(raw), 1 << 20):
        kinds += np.bincount(_CLASS[raw[i : i + (1 << 20)]], minlength=6)
    ink, letters = max(1, int(kinds[1:].sum())), max(1, int(kinds[_UPPER] + kinds[_LOWER] + kinds[_WIDE]))
    n, lengths, seen = len(words), list(map(len, words)), Counter(words)
    lines = [x for x in text.splitlines() if x.strip()]
    return (
        float(n), sum(lengths) / n, float(max(lengths)), kinds[_UPPER] / letters, kinds[_DIGIT] / ink, kinds[_SYMBOL] / ink, kinds[_WIDE] / ink,
        len(_MARKED.findall(text)) / n, sum(c for w, c in seen.items() if len(w) == 1 and not w.isalnum()) / n, sum(c for w, c in seen.items() if w[0].isupper()) / n,
        1 - len(seen) / n, max(seen.values()) / n, 1 - len(set(lines)) / len(lines), n / len(lines), sum(x.rstrip()[-1] in ".?!" for x in lines) / len(lines), n / max(1, text.count(".")),
    )


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, is above, threshold), all of which must hold


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rng, depth: int = 3, cuts: int = 24, least: float = 0.005) -> list[Rule]:
    """Paths of a tree that is grown by weighted Gini gain on a random half of the statistics at each node."""
    rules, waiting = [], [((), np.flatnonzero(weight))]
    total = weight.sum()
    while waiting:
        path, rows = waiting.pop()
        if path:
            rules.append(path)
        w, t = weight[rows], y[rows]
        p = float((w * t).sum() / w.sum())
        if len(path) == depth or p in (0.0, 1.0):
            continue
        best = (1e-9, None)
        for f in rng.choice(x.shape[1], x.shape[1] // 2, replace=False):
            v = x[rows, f]
            for c in np.unique(np.quantile(v, np.linspace(0.02, 0.98, cuts), method="lower")):
                high = v > c
                a = float(w[high].sum())
                b = float(w.sum()) - a
                if min(a, b) < least * total:
                    continue
                pa, pb = float((w * t)[high].sum()) / a, float((w * t)[~high].sum()) / b
                gain = (a + b) * p * (1 - p) - a * pa * (1 - pa) - b * pb * (1 - pb)
                if gain > best[0]:
                    best = (gain, (int(f), float(c)))
        if best[1]:
            f, c = best[1]
            high = x[rows, f] > c
            waiting += [((*path, (f, True, c)), rows[high]), ((*path, (f, False, c)), rows[~high])]
    return rules


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, c in rule:
        out &= (x[:, f] > c) if above else (x[:, f] <= c)
    return out


@dataclass
class Ensemble:
    bias: float
    rules: list[tuple[Rule, float]]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + sum((w * holds(r, x) for r, w in self.rules), np.zeros(len(x))), -60, 60)))

    def column(self) -> Column:
        """The score as an expression over the columns named by STATISTICS."""
        total = F.lit(float(self.bias))
        for rule, w in self.rules:
            test = None
            for f, above, c in rule:
                part = F.col(STATISTICS[f]) > c if above else F.col(STATISTICS[f]) <= c
                test = part if test is None else test & part
            total = total + F.when(test, float(w)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, penalty: float = 0.002, steps: int = 300, seed: int = 42) -> Ensemble:
    """Rules from trees on random halves of the rows, then lasso logistic weights by accelerated descent."""
    if not len(y):
        return Ensemble(0.0, [])
    share = float(y.mean())
    if share in (0.0, 1.0):
        return Ensemble(math.log((share * len(y) + 1) / ((1 - share) * len(y) + 1)), [])
    rng, rules = np.random.default_rng(seed), {}
    for _ in range(trees):
        weight = (rng.random(len(y)) < 0.5) * np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
        if len({*y[weight > 0]}) == 2:
            for r in grow(x, y, weight, rng):
                rules.setdefault(np.packbits(holds(r, x)).tobytes(), r)
    rules = list(rules.values())
    if not rules:
        return Ensemble(math.log(share / (1 - share)), [])
    z = np.stack([holds(r, x) for r in rules], axis=1).astype(np.float64)
    mean = z.mean(0)
    z -= mean
    v = rng.standard_normal(z.shape[1])
    top = 1.0
    for _ in range(30):
        v = z.T @ (z @ v) / len(y)
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    rate = 1 / (0.25 * top * 1.05 + 1e-9)
    w = last = np.zeros(z.shape[1])
    bias = math.log(share / (1 - share))
    for k in range(steps):
        at = w + k / (k + 3) * (w - last)
        off = 1 / (1 + np.exp(-np.clip(bias + z @ at, -60, 60))) - y
        moved = at - rate * (z.T @ off) / len(y)
        last, w = w, np.sign(moved) * np.maximum(np.abs(moved) - rate * penalty, 0)
        bias -= 2 * float(off.mean())
    bias -= float(mean @ w)
    return Ensemble(bias, [(r, float(c)) for r, c in zip(rules, w) if c])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = 6000, good: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``.

    Labels are learned from rows outside fold 2 of the id's crc32; labels of ids that aren't in ``docs``
    and null labels don't count. Null and wordless texts have zero statistics and are scored like any
    other; without labels every score is 0.5; rows that repeat come back as often as they came, with the
    same score; an empty table gives an empty one. Only the columns named are read.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    stats = cut(mapped(narrow, ["id"], ["t"], ", ".join(f"{s} double" for s in STATISTICS), lambda texts: tuple(zip(*map(statistics, texts))) or ((),) * len(STATISTICS)))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where((crc_fold("id") != 2) & F.col("y").isNotNull())
    marked = cut(stats.join(marks, "id").select(*STATISTICS, "y", F.xxhash64(F.lit(42), "id").alias("draw"), "id"))
    # a share of the draws that holds twice the rows wanted, so that no task sends a full sample of its own
    share = min(1.0, 2.0 * rows / max(1, marked.count()))
    some = marked.where(F.col("draw") < int(-(2.0**63) + share * 2.0**64)) if share < 1 else marked
    sample = some.orderBy("draw", "id", "y", *STATISTICS[:3]).limit(rows).collect()
    x = np.array([r[: len(STATISTICS)] for r in sample], float).reshape(-1, len(STATISTICS))
    model = fit(x, np.array([int(r["y"] > 0) for r in sample], float))
    out = stats.select(F.col("id").alias(id_col), (crc_fold("id") == 2).alias("held_out"), model.column().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= good).cast("int"))
