"""Secret scans: three fixed patterns, and a randomness test battery with false-discovery control.

The battery takes tokens of 20 and more symbols, infers their encoding from their symbols and asks two
things of each. Is it consistent with uniform random symbols: chi-squared uniformity over the
alphabet, a runs test about the alphabet's middle and the lag-one serial correlation, combined by
Fisher's rule, must not reject. Is it unlike running text: the likelihood ratio of the uniform
alphabet against the corpus's own symbol frequencies is an e-value, which grows with the token's
length; the e-value form of the Benjamini-Hochberg rule holds the rate of false discoveries below
``fdr`` within each band of lengths. Symbol counts and the e-values of all tokens of all documents
enter, as two histograms of fixed size.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mapped

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
#: Inferred encodings, narrowest first: name, pattern of the whole token, alphabet in order of value.
_D, _L, _U = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [
    (name, re.compile(f"[{re.escape(letters)}]+"), np.array([letters.find(chr(i)) for i in range(128)]), len(letters))
    for name, letters in (("hex", _D + "abcdef"), ("HEX", _D + "ABCDEF"), ("base32", _U + "234567"), ("base36", _D + _L), ("BASE36", _D + _U), ("base62", _U + _L + _D), ("base64", _U + _L + _D + "+/"), ("base64url", _U + _L + _D + "-_"))
]
_SYMBOLS = _U + _L + _D + "+/-_"
_CODE = np.array([_SYMBOLS.find(chr(i)) for i in range(128)])
#: Lower ends of the bands of lengths; e-values are binned by a quarter nat, the last bin open.
BANDS, BINS = (20, 28, 40, 64), 400


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index into KINDS, end) of the three fixed patterns, leftmost and non-overlapping per kind."""
    found, low = [], text.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def tokens(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi2_tail(x: float, k: int) -> float:
    """Upper tail of chi-squared: exact up to 200 degrees, Wilson and Hilferty's normal form beyond."""
    if x <= 0:
        return 1.0
    if k > 200 or x > 1400:
        return normal_tail(((x / k) ** (1 / 3) - 1 + 2 / (9 * k)) / math.sqrt(2 / (9 * k)))
    if k % 2:
        total, term, first = math.erfc(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2), 3
    else:
        total, term, first = 0.0, math.exp(-x / 2), 2
    for i in range(first, k + 1, 2):
        total += term
        term *= x / i
    return min(1.0, total)


def battery(token: str) -> tuple[str | None, float]:
    """The inferred encoding of a token, and Fisher's combined p-value of uniform randomness."""
    body = token.rstrip("=")
    for name, pattern, values, size in ENCODINGS:
        if pattern.fullmatch(body):
            break
    else:
        return None, 0.0
    v, n = values[np.frombuffer(body.encode(), np.uint8)], len(body)
    cells = max(2, min(size, n // 4))
    share = np.bincount(np.arange(size) * cells // size, minlength=cells) / size
    seen = np.bincount(v * cells // size, minlength=cells)
    p1 = chi2_tail(float(((seen - n * share) ** 2 / (n * share)).sum()), cells - 1)
    high = 2 * v >= size
    a, b = int(high.sum()), int(n - high.sum())
    if a and b:
        mean = 1 + 2 * a * b / n
        var = max(1e-9, (mean - 1) * (mean - 2) / (n - 1))
        p2 = 2 * normal_tail(max(0.0, abs(1 + int((high[1:] != high[:-1]).sum()) - mean) - 0.5) / math.sqrt(var))
    else:
        p2 = 2.0 ** (1 - n)
    d = v - v.mean()
    power = float((d * d).sum())
    p3 = 2 * normal_tail(abs((float((d[1:] * d[:-1]).sum()) / power + 1 / n) * math.sqrt(n))) if power else 0.0
    ps = [min(1.0, max(p, 1e-300)) for p in (p1, p2, p3)]
    return name, chi2_tail(-2 * sum(map(math.log, ps)), 6)


@dataclass
class Model:
    log_share: np.ndarray  # of each symbol in running text
    least: dict[int, float]  # log e-value from which a token of this band counts

    def log_e(self, token: str, size: int) -> float:
        body = np.frombuffer(token.rstrip("=").encode(), np.uint8)
        return float(-len(body) * math.log(size) - self.log_share[_CODE[body]].sum())


SIZE = {name: size for name, _, _, size in ENCODINGS}


def band(length: int) -> int:
    return sum(length >= b for b in BANDS) - 1


def symbol_counts(texts) -> np.ndarray:
    total = np.zeros(256, np.int64)
    for t in texts:
        raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
        for i in range(0, len(raw), 1 << 20):
            total += np.bincount(raw[i : i + (1 << 20)], minlength=256)
    return total[[ord(c) for c in _SYMBOLS]]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.01) -> DataFrame:
    """One pass over whole texts: a row per document with its base spans and the tokens that the battery
    doesn't reject; the first row of each batch also has the batch's symbol counts."""
    def run(texts):
        texts = ["" if t is None else t for t in texts]
        base, found = [], []
        for t in texts:
            base.append([x for s in base_spans(t) for x in s])
            some = []
            for a, b in tokens(t):
                name, p = battery(t[a:b])
                if name and p >= alpha:
                    some.append({"start": a, "end": b, "encoding": name, "p": p, "body": t[a:b]})
            found.append(some)
        counts = [symbol_counts(texts).tolist(), *[None] * (len(texts) - 1)]
        return base, found, counts[: len(texts)]

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return mapped(narrow, ["id"], ["t"], "base array<long>, tokens array<struct<start:long,end:long,encoding:string,p:double,body:string>>, symbols array<long>", run)


def fit(scanned: DataFrame, fdr: float = 0.01) -> Model:
    """Symbol shares and, for each band of lengths, the e-value from which tokens are discoveries."""
    sums = scanned.where("symbols IS NOT NULL").select(F.posexplode("symbols")).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    counts = np.ones(len(_SYMBOLS))
    for r in sums:
        counts[r["pos"]] += r["n"]
    model = Model(np.log(counts / counts.sum()), {})

    @F.pandas_udf("int")
    def cell(body: pd.Series, encoding: pd.Series) -> pd.Series:
        return pd.Series([band(len(b)) * BINS + int(min(BINS - 1, max(0, 4 * model.log_e(b, SIZE[e])))) for b, e in zip(body, encoding)], dtype="int32")

    every = scanned.select(F.explode("tokens").alias("x"))
    seen = np.zeros((len(BANDS), BINS), np.int64)
    for r in every.select(cell("x.body", "x.encoding").alias("cell")).groupBy("cell").count().collect():
        seen[divmod(r["cell"], BINS)] = r["count"]
    for i, row in enumerate(seen):
        m, above = int(row.sum()), np.cumsum(row[::-1])[::-1]
        good = [b for b in range(BINS) if above[b] and b / 4 >= math.log(max(1, m) / (fdr * above[b]))]
        model.least[i] = min(good) / 4 if good else math.inf
    return model


def discoveries(model: Model, found) -> list[tuple[int, int, int]]:
    """Spans of the tokens (start, end, encoding, body) that pass the false-discovery rule."""
    return [(a, 3, b) for a, b, encoding, body in found if model.log_e(body, SIZE[encoding]) >= model.least[band(b - a)]]


def label(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.01, fdr: float = 0.01) -> DataFrame:
    """Spans of every row: id, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    Null and empty texts have no spans (the hash is that of the empty text); long texts are scanned
    whole; repeated rows come back as often as they came; an empty table gives an empty one; other
    columns are ignored. Offsets are code points, ends exclusive.
    """
    scanned = cut(scan(docs, id_col, text_col, alpha))
    model = fit(scanned, fdr)
    def run(bases, tokens_):
        out = []
        for flat, found in zip(bases, tokens_):
            base = [tuple(flat[i : i + 3]) for i in range(0, len(flat), 3)]
            more = discoveries(model, [(x["start"], x["end"], x["encoding"], x["body"]) for x in found])
            n = [sum(k == i for _, k, _ in base) for i in range(3)]
            out.append((*n, len(more), hashlib.sha256(label(base).encode()).hexdigest(), label(base + more)))
        return tuple(zip(*out)) or ((),) * 6

    out = mapped(scanned, ["id"], ["base", "tokens"], "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string", run)
    return out.withColumnRenamed("id", id_col)


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", mark: str = "[SECRET]", alpha: float = 0.01, fdr: float = 0.01) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans get one mark.

    Nulls and empty texts stay; long texts are scanned whole; repeated rows come back as often as they came, an
    empty table gives an empty one; all other columns pass, whatever their names.
    """
    model = fit(cut(scan(docs, id_col, text_col, alpha)), fdr)

    def clean(text):
        if text is None:
            return None
        found = []
        for a, b in tokens(text):
            name, p = battery(text[a:b])
            if name and p >= alpha:
                found.append((a, b, name, text[a:b]))
        out, at = [], 0
        for a, _, b in sorted(base_spans(text) + discoveries(model, found)):
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join([*out, text[at:]]) if out else text

    out = mapped(docs.withColumn(text_col, F.col(text_col).cast("string")), docs.columns, [text_col], f"`{text_col}` string", lambda texts: ([clean(t) for t in texts],))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
