"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Letters in lower case, anything else as one separator each; hashed n-grams of one
to three characters.  Inverse document frequencies come from all learning
documents; weights from a bounded sample, by follow-the-regularised-leader with
elastic-net penalties (most weights are exactly zero); confidences from a
temperature fitted on sample rows that the weights have not seen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import cut, first_by_hash, keep_rows, map_pandas
from fleetlens.llm.learn import ftrl, softmax, temperature
from fleetlens.llm.texts import codes, letters, pieces, runs

BITS = 13
DIMS = 1 << BITS
#: Multipliers of the n-gram hash (fixed odd values).
MULT = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))
UNDECIDED = "und"


def _grams(text: str, starts: int | None = None) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text, one array per order, that begin in its first ``starts`` characters."""
    c = codes(text.lower())
    is_letter = letters()[c]
    if not is_letter.any():
        return
    c = np.where(is_letter, c, np.uint32(32))
    n = len(c) if starts is None or starts >= len(text) else starts
    shift = np.uint32(32 - BITS)
    one = c * MULT[0]
    yield (one[:n][is_letter[:n]] ^ np.uint32(0x9E3779B9)) >> shift
    if len(c) > 1:
        two = one[:-1] + c[1:] * MULT[1]
        keep = is_letter[:-1] | is_letter[1:]
        yield (two[:n][keep[:n]] * MULT[2]) >> shift
    if len(c) > 2:
        three = (two[:-1] ^ (two[:-1] >> np.uint32(15))) * MULT[1] + c[2:] * MULT[2]
        yield (three[:n][is_letter[1:-1][:n]] * MULT[0]) >> shift


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashed n-grams, their counts) of a whole text."""
    total = np.zeros(DIMS, np.int64)
    for piece, starts in pieces(text or ""):
        for g in _grams(piece, starts):
            total += np.bincount(g, minlength=DIMS)
    at = np.flatnonzero(total)
    return at, total[at]


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """(documents that hold each hashed n-gram, documents), over all rows.

    Each task adds its documents up; one short row per task and block of n-grams is
    shuffled, and DIMS + 1 sums come to the driver.
    """
    width = 256

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(DIMS, np.int64)
        n = 0
        for b in batches:
            for t in b[text]:
                seen = np.zeros(DIMS, bool)
                for piece, starts in pieces(t or ""):
                    for g in _grams(piece, starts):
                        seen[g] = True
                df += seen
                n += 1
        yield pd.DataFrame({"part": np.arange(DIMS // width + 1), "sums": [*df.reshape(-1, width).tolist(), [n]]})

    parts = docs.select(docs[text].alias(text)).mapInPandas(count, "part int, sums array<long>")
    rows = (parts.select("part", F.posexplode("sums").alias("k", "n")).groupBy("part", "k").agg(F.sum("n").alias("n"))
            .collect())
    df = np.zeros(DIMS, np.int64)
    n = 0
    for r in rows:
        if r["part"] == DIMS // width:
            n = r["n"]
        else:
            df[r["part"] * width + r["k"]] = r["n"]
    return df, n


def bounded_sample(rows: DataFrame, per_label: int, most_rows: int, max_chars: int = 20_000) -> list:
    """At most ``per_label`` rows (language, hashed n-grams, their counts) of each language.

    Texts of up to ``max_chars`` with an id come first; longer ones and those without an
    id fill up languages that have too few of these, so no language with a letter in
    its texts is left out.  Of more than ``most_rows`` / ``per_label`` languages each has fewer
    rows, one at least.  Whole texts are reduced to counts inside the tasks.
    """
    text, key = F.col("__text"), F.col("__id")
    first = (F.length(text) <= max_chars) & key.isNotNull()
    named = rows.where(text.rlike(r"\p{L}")).select(
        F.when(key.isNotNull(), key).otherwise(F.concat(F.lit("text:"), F.md5(text.cast("binary")))).alias("__key"),
        "__lang", F.when(first, 0).otherwise(1).alias("__tier"), "__text")
    keys = cut(named.select("__key", "__lang", "__tier").distinct())
    languages = keys.select("__lang").distinct().count()
    per_label = max(1, min(per_label, most_rows // max(1, languages)))
    group = F.struct("__lang", "__tier")
    few = first_by_hash(keys.withColumn("__group", group), "__group", "__key", per_label).drop("__group")
    order = Window.partitionBy("__lang").orderBy("__tier", F.xxhash64("__key", F.lit(17)), "__key")
    few = few.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= per_label)  # of at most 2 per_label
    few = few.select(F.col("__key").alias("__k"), F.col("__lang").alias("__l"), F.col("__tier").alias("__t"))

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts = [gram_counts(t) for t in b["__text"]]
            yield pd.DataFrame({"__key": b["__key"], "__lang": b["__lang"],
                                "grams": [zlib.compress(a.astype(np.uint16).tobytes() + n.tobytes(), 1) for a, n in counts]})

    met = (F.col("__key") == F.col("__k")) & (F.col("__lang") == F.col("__l")) & (F.col("__tier") == F.col("__t"))
    got = (named.join(F.broadcast(few), met).select("__key", "__lang", "__text")
           .mapInPandas(reduce, "__key string, __lang string, grams binary").dropDuplicates(["__key", "__lang"]))
    out = []
    for r in sorted(got.collect(), key=lambda r: (r["__key"][::-1], r["__lang"])):
        raw = zlib.decompress(r["grams"])
        k = len(raw) // 10  # two bytes an n-gram, eight a count
        out.append((r["__lang"], np.frombuffer(raw[:2 * k], np.uint16), np.frombuffer(raw[2 * k:], np.int64)))
    return out


@dataclass
class LanguageModel:
    classes: list[str]
    weights: np.ndarray  # DIMS x classes, with the inverse document frequencies in it
    temperature: float

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities per class, whether the text has a letter)."""
        z = np.zeros((len(texts), max(1, len(self.classes))))
        some = np.zeros(len(texts), bool)
        for i, t in enumerate(texts):
            n = 0
            for piece, starts in pieces(t or ""):
                for g in _grams(piece, starts):
                    if len(self.classes):
                        z[i] += np.bincount(g, minlength=DIMS) @ self.weights if len(g) > DIMS else self.weights[g].sum(0)
                    n += len(g)
            if n:
                z[i] *= SCALE / n
                some[i] = True
        return softmax(z / self.temperature), some


#: Features are shares of a text's n-grams; this brings them near one.
SCALE = 30.0


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        per_language: int = 1500, most_rows: int = 300_000) -> LanguageModel:
    """Learn from the rows of ``docs`` with a text and a language.

    Weights and temperature come from at most ``per_language`` rows of every language
    whose texts hold a letter, and about ``most_rows`` rows in all; document frequencies from
    all rows.  Without such rows the model knows no language.
    """
    rows = docs.select(docs[text].alias("__text"), docs[lang].cast("string").alias("__lang"),
                       docs[doc_id].cast("string").alias("__id")).where("__text is not null and __lang is not null")
    df, n = document_frequencies(rows, "__text")
    idf = np.log((1.0 + n) / (1.0 + df)) + 0.1
    sample = [r for r in bounded_sample(rows, per_language, most_rows) if len(r[1])]
    classes = sorted({r[0] for r in sample})
    if not classes:
        return LanguageModel([], np.zeros((DIMS, 1)), 1.0)
    number = {c: k for k, c in enumerate(classes)}
    x, y, back = [], [], []
    seen = [0] * len(classes)
    for label, at, c in sample:
        x.append((at, c * idf[at] * (SCALE / c.sum())))
        y.append(number[label])
        seen[y[-1]] += 1
        back.append(seen[y[-1]] % 5 == 0)  # of each language a fifth, none where it has less than five rows
    y, back = np.array(y, int), np.array(back)
    w = ftrl([v for v, b in zip(x, back) if not b], y[~back], len(classes), DIMS)
    logits = np.array([v @ w[at] for (at, v), b in zip(x, back) if b]).reshape(-1, len(classes))
    return LanguageModel(classes, (w * idf[:, None]).astype(np.float64), max(temperature(logits, y[back]), 1e-3))


def predict_batches(model, names: tuple[str, str, str]):
    """Adds (text column) -> prediction and score to pandas batches."""
    text, out, score = names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: LanguageModel = model.value
        for b in batches:
            lang, conf = [], []
            for part in runs([t if isinstance(t, str) else "" for t in b[text]]):
                p, some = m.scores(part)
                for row, ok in zip(p, some):
                    k = int(np.argmax(row))
                    sure = ok and m.classes
                    lang.append(m.classes[k] if sure else UNDECIDED)
                    conf.append(float(row[k]) if sure else 0.0)
            b[out], b[score] = lang, conf
            yield b
    return run


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its calibrated probability; no shuffle.

    The result columns replace columns of those names.  A text that is NULL or holds
    no letter is ``und`` with score 0.  Whole texts are read, in pieces.
    """
    d = docs.drop(out, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS x languages numbers
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields)
    return map_pandas(d, predict_batches(shared, (text, out, score)), f"{schema}, `{out}` string, `{score}` double")


def keep_known(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = 0.4) -> DataFrame:
    """``docs`` without those of no identifiable language: no letter, or a confidence below ``least``.

    A model that knows no language rejects only texts without a letter.  All columns stay;
    repeated rows stay or go together; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m: LanguageModel = shared.value

        def test(texts: list[str | None]) -> list[bool]:
            out: list[bool] = []
            for part in runs([t or "" for t in texts]):
                p, some = m.scores(part)
                out += (some & ((p.max(1) >= least) | (not m.classes))).tolist()
            return out
        return test
    return keep_rows(docs, text, make)
