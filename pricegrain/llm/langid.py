"""Language identification by error-correcting output codes over hashed byte n-grams.

Every language gets a codeword of +1/-1 bits; a binary n-gram classifier predicts each bit. Decoding
sums the logistic loss of a codeword's bits, each weighted by how well its classifier does beyond
chance, and takes the nearest codeword. A text whose nearest codeword isn't clearly nearer than the
rest is flagged as ambiguous.

The classifiers are fitted on a bounded sample: about ``rows_per_language`` labelled rows of each
language, and about ``most_rows`` in all, drawn by a hash of the id and the text. Predictions read whole texts.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, mapped, tidy

BUCKETS = 1 << 12
#: Bytes hashed at once; long texts go in steps that overlap by two bytes.
STEP = 1 << 20
#: ASCII bytes that aren't lower-case letters become spaces.
_FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ngrams(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte bigrams and trigrams: a vector of unit length."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for i in range(0, max(1, len(raw) - 2), STEP):
        b = _FOLD[raw[i : i + STEP + 2]]
        b = b[np.concatenate(([True], (b[1:] != 32) | (b[:-1] != 32)))].astype(np.uint32)
        two = b[:-1] * np.uint32(257) + b[1:]
        three = two[:-1] * np.uint32(263) + b[2:]
        for x in (two * np.uint32(2654435761), three * np.uint32(2246822519)):
            counts += np.bincount(x >> np.uint32(20), minlength=BUCKETS)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k rows of +1/-1 bits: every split of up to 7 classes, else 10 log2(k) random balanced splits."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 7:
        return np.array([(1, *bits) for bits in itertools.product((1, -1), repeat=k - 1)][1:], float).T
    rng, n = np.random.default_rng(seed), int(np.ceil(10 * np.log2(k)))
    best, most = None, -1
    for _ in range(50):
        code = np.stack([rng.permutation(np.where(np.arange(k) % 2, 1.0, -1.0)) for _ in range(n)], axis=1)
        apart = min(int((code[i] != code[j]).sum()) for i in range(k) for j in range(i))
        if apart > most:
            best, most = code, apart
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    mean: np.ndarray
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray
    bit_weight: np.ndarray

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the languages from loss-weighted decoding of the bit margins of ``x``."""
        f = (x - self.mean) @ self.weights + self.bias
        loss = np.logaddexp(0, -self.code * f) @ self.bit_weight
        p = np.exp(loss.min() - loss)
        return p / p.sum()


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 120, ridge: float = 1e-4) -> Model:
    """Logistic bit classifiers by accelerated gradient descent; languages weigh alike."""
    code, mean = codewords(len(languages)), x.mean(0)
    x, target = x - mean, codewords(len(languages))[y].astype(np.float32)
    share = np.bincount(y, minlength=len(languages))
    row = (1 / (len(languages) * share[y])).astype(np.float32)[:, None]
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):
        v = x.T @ (row[:, 0] * (x @ v))
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    rate = 1 / (0.25 * (top * 1.1 + 1e-3) + ridge)
    w = last = np.zeros((x.shape[1], code.shape[1]), np.float32)
    bias = np.zeros(code.shape[1], np.float32)
    for k in range(steps):
        at = w + (k - 1) / (k + 2) * (w - last) if k else w
        pull = -row * target / (1 + np.exp(np.clip(target * (x @ at + bias), -50, 50)))
        last, w = w, at - rate * (x.T @ pull + ridge * at)
        bias = bias - 2 * pull.sum(0)
    right = (row * ((x @ w + bias) * target > 0)).sum(0)
    bit = np.maximum(right - 0.5, 1e-3)
    return Model(languages, code, mean, w, bias, bit / bit.mean())


def train(docs: DataFrame, rows_per_language: int = 500, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_rows: int = 20_000) -> Model | None:
    """The model learned from non-null texts and languages outside fold 2; None if there are none.

    A language has as many rows as any other where it has enough: ``rows_per_language``, or an even share of
    ``most_rows`` where there are more languages than that allows.
    """
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("lang")).where((crc_fold("id") != 2) & F.col("lang").isNotNull() & F.col("t").isNotNull())
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return None
    cap = min(rows_per_language, max(1, most_rows // len(counts)))
    keep = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, cap / n))])
    draw = F.pmod(F.xxhash64("id", "t", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)

    @tidy
    def run(batches):
        for frame in batches:
            frame = frame[[has_letter(t) for t in frame["t"]]]
            yield pd.DataFrame({"lang": frame["lang"], "x": [ngrams(t).astype(np.float16).tobytes() for t in frame["t"]]})

    rows = usable.where(draw < keep[F.col("lang")]).select("t", "lang").mapInPandas(run, "lang string, x binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))  # the order of rows must not sway the sums
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return None
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    return fit(x, np.array([languages.index(r["lang"]) for r in rows]), languages)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", clear: float = 0.6) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous.

    ``und`` with score 0 where the text is null or has no letter (or nothing was learned); ambiguous
    where the score is below ``clear``. All other columns pass unchanged, unless they have one of
    these three names, which are replaced.
    """
    def run(texts):
        names, scores = [], []
        for t in texts:
            if model is None or not has_letter(t):
                names.append("und")
                scores.append(0.0)
                continue
            p = model.decode(ngrams(t))
            names.append(model.languages[int(p.argmax())])
            scores.append(float(p.max()))
        return names, scores, [s < clear for s in scores]

    return mapped(docs, docs.columns, [text_col], "lang_pred string, score double, ambiguous boolean", run)


def identify(docs: DataFrame, rows_per_language: int = 500, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, ambiguous) of every row; see ``train`` and ``predict``.

    Rows with a null id count as fold 0; null, empty and letterless texts are ``und``; repeated rows
    come back as often as they came, with the same prediction; an empty table gives an empty one.
    """
    model = train(docs, rows_per_language, id_col, text_col, lang_col)
    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    out = predict(narrow.withColumn("held_out", crc_fold(id_col) == 2), model, id_col, "_text")
    return out.select(id_col, "held_out", "lang_pred", "score", "ambiguous")
