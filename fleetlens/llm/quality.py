"""Quality classifier: ridge regression on random Fourier features of document statistics.

Every document is reduced to a short vector of statistics of its whole text.
Random cosines of the standardised vector approximate a Gaussian kernel; each
partition adds up its part of the normal equations, Spark sums them, and the
small system is solved once.  An isotonic fit on rows that the equations have not
seen turns the ridge score into a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import cut, map_pandas
from fleetlens.llm.learn import isotonic

NAMES = ("log_words", "mean_word", "sd_word", "upper", "digit", "symbol", "end_mark", "bang", "bar", "distinct", "top_word",
         "same_as_before", "distinct_pairs", "distinct_fives", "short_words", "long_words", "marked_words", "caps_words",
         "line_words", "same_lines", "wide_letters", "control", "bare_symbols", "sentences")


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of NAMES (an empty text: zeros)."""
    t = text or ""
    words = t.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    chars = len(t)
    raw = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = np.bincount(np.minimum(raw, 128), minlength=129)
    upper = int(low[65:91].sum())
    letters = upper + int(low[97:123].sum()) + int(low[128])
    digits = int(low[48:58].sum())
    blank = int(low[32] + low[9:14].sum())
    marks = int(low[46] + low[44] + low[63] + low[59] + low[58])
    symbols = int(low[33:128].sum()) - upper - int(low[97:123].sum()) - digits - marks
    lengths = np.fromiter(map(len, words), np.int64, n)
    small = [w.lower().strip(".,;:!?") for w in words]
    count = Counter(small)
    pairs = len(set(zip(small, small[1:]))) / max(1, n - 1)
    fives = len(set(zip(small, small[1:], small[2:], small[3:], small[4:]))) / max(1, n - 4) if n >= 5 else 1.0
    again = sum(a == b for a, b in zip(small, small[1:])) / max(1, n - 1)
    lines = [x for x in t.split("\n") if x.strip()]
    marked = sum(not w[-1].isalnum() and w[-1] not in ".,;:?\"')" for w in words)
    caps = sum(len(w) > 1 and w.isupper() for w in words)
    bare = sum(not any(map(str.isalnum, w)) for w in set(words))
    return [np.log1p(n), lengths.mean(), lengths.std(), upper / max(1, letters), digits / chars, symbols / chars, marks / chars,
            low[33] / n, low[124] / n, len(count) / n ** 0.8, count.most_common(1)[0][1] / n, again, pairs, fives,
            float((lengths <= 3).mean()), float((lengths >= 12).mean()), marked / n, caps / n, np.log1p(n / max(1, len(lines))),
            1 - len(set(lines)) / max(1, len(lines)), low[128] / max(1, letters), (int(low[:32].sum()) - int(low[9:14].sum())) / chars,
            np.log1p(bare) / np.log1p(n), np.log1p(int(low[46])) / np.log1p(n)]


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray  # statistics x features
    phases: np.ndarray
    weights: np.ndarray  # features + 1
    knots: tuple[np.ndarray, np.ndarray]

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of rows of statistics, and a constant."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases)), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.knots), 0.0, 1.0)


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64) if len(col) else np.zeros((0, len(NAMES)))


def describe(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with column ``__x`` (the statistics) in place of the text; one pass, no shuffle."""
    rest = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["__x"] = [statistics(t if isinstance(t, str) else "") for t in b[text]]
            yield b.drop(columns=[text])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "__x array<double>"])
    return map_pandas(docs.select(*[docs[f.name] for f in rest], docs[text]), run, schema)


def _sums(rows: DataFrame, width: int, of) -> np.ndarray:
    """Sum over all rows of the matrix that ``of`` makes of each batch, ``width`` numbers to a row of it.

    A task adds its batches up and sends one matrix, cut in rows.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            if len(b):
                m = of(b)
                total = m if total is None else total + m
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "v": total.tolist()})

    cols = [F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(width)]
    out = rows.mapInPandas(run, "i int, v array<double>").groupBy("i").agg(*cols).orderBy("i").collect()
    return np.array([[r[j + 1] for j in range(width)] for r in out])


def fit(rows: DataFrame, label: str = "label", features: int = 192, gamma: float = 0.04, ridge: float = 3e-3,
        seed: int = 7) -> QualityModel | None:
    """Learn from (``__x``, label 0..1, fold): all rows, none of them collected.

    Rows of fold 0 to 3 enter the normal equations, rows of fold 4 the calibration.
    None if there is no row or only one label.
    """
    k = len(NAMES)
    stat = _sums(rows.select("__x"), k, lambda b: np.vstack([_matrix(b["__x"]).sum(0), (_matrix(b["__x"]) ** 2).sum(0),
                                                            np.full(k, float(len(b)))]))
    if not len(stat):
        return None
    mean = stat[0] / stat[2]
    scale = np.sqrt(np.maximum(stat[1] / stat[2] - mean ** 2, 0)) + 1e-3
    rng = np.random.default_rng(seed)
    model = QualityModel(mean, scale, rng.normal(0, np.sqrt(2 * gamma), (k, features)), rng.uniform(0, 2 * np.pi, features),
                         np.zeros(features + 1), (np.array([0.0]), np.array([0.5])))

    def normal(b: pd.DataFrame) -> np.ndarray:
        z, y = model.lift(_matrix(b["__x"])), b["y"].to_numpy(np.float64)
        return np.hstack([z.T @ z, (z.T @ y)[:, None]])

    xy = rows.select("__x", F.col(label).cast("double").alias("y"), "fold")
    eq = _sums(xy.where("fold < 4"), features + 2, normal)
    if not len(eq):
        return None
    a, b = eq[:, :-1], eq[:, -1]
    n = a[-1, -1]
    penalty = np.full(features + 1, ridge * n / features)
    penalty[-1] = 1e-9
    model.weights = np.linalg.solve(a + np.diag(penalty), b)
    bins = 400
    lo, hi = -0.5, 1.5

    def histogram(b: pd.DataFrame) -> np.ndarray:
        at = np.clip(((model.raw(_matrix(b["__x"])) - lo) / (hi - lo) * bins).astype(int), 0, bins - 1)
        y = b["y"].to_numpy(np.float64)
        return np.vstack([np.bincount(at, minlength=bins), np.bincount(at, weights=y, minlength=bins)]).T.astype(float)

    h = _sums(xy.where("fold = 4"), 2, histogram)
    if not len(h) or not h[:, 0].sum():
        h = _sums(xy, 2, histogram)
    at = np.flatnonzero(h[:, 0])
    x = lo + (at + 0.5) * (hi - lo) / bins
    model.knots = isotonic(x, h[at, 1] / h[at, 0], h[at, 0])
    return model


def apply(described: DataFrame, model: QualityModel | None, score: str = "score") -> DataFrame:
    """``described`` with the calibrated score in place of the statistics (0.5 without a model)."""
    rest = [f for f in described.schema.fields if f.name not in ("__x", score)]
    shared = described.sparkSession.sparkContext.broadcast(model)  # a few hundred kB, whatever the input

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            b[score] = m.score(_matrix(b["__x"])) if m is not None and len(b) else 0.5
            yield b.drop(columns=["__x"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), f"`{score}` double"])
    return map_pandas(described.select(*[described[f.name] for f in rest], "__x"), run, schema)


def classify(docs: DataFrame, labels: DataFrame, may_learn, label: str = "quality", doc_id: str = "doc_id",
             text: str = "text", threshold: float = 0.7, **params) -> DataFrame:
    """(doc_id, learnt_from boolean, score, predicted) of every row of ``docs``.

    ``may_learn``: condition on the id; only labels of such rows are read.  Labels that
    are NULL or have no document teach nothing; an id with several labels has their
    mean.  NULL and empty texts have statistics of zero and are scored by them.
    Repeated rows are scored each; an empty table gives an empty result.
    """
    d = docs.select(docs[doc_id].alias("__id"), F.coalesce(may_learn, F.lit(False)).alias("__learn"), docs[text].alias("__text"))
    x = cut(describe(d, "__text"))
    y = (labels.select(labels[doc_id].alias("__lid"), labels[label].cast("double").alias("label"))
         .where("__lid is not null and label is not null").groupBy("__lid").agg(F.avg("label").alias("label")))
    rows = cut(x.where("__learn").join(y, F.col("__id") == F.col("__lid"))
               .select("__x", "label", F.pmod(F.xxhash64("__id", F.lit(5)), F.lit(5)).alias("fold")))
    out = apply(x, fit(rows, **params))
    return out.select(F.col("__id").alias("doc_id"), F.col("__learn").alias("learnt_from"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
