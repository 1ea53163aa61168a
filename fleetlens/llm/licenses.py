"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

Lines are classified each; a long line is read in overlapping windows.  Notices that
are wrapped over lines, or that share a line with another family's, are found in whole
blocks (consecutive lines that hold a word, without comment marks): a stretch that holds
enough of a notice's bigrams counts when it is classified as that family.  Features are
word uni- and bigrams that occur in notices.  A multinomial logistic regression
with an l1 penalty (sparse weights) tells the families and ``unknown`` apart; it is
trained on varied notices, on made-up mixtures of notice words, and on a bounded
sample of paragraphs of the corpus.  A temperature fitted on unseen examples
calibrates it.  A predicted family counts when the paragraph also holds enough of
one of its notices.  No word is skipped: a paragraph without any notice word has
the constant score of the unknown class, so it needs no arithmetic.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import first_by_hash, map_pandas
from fleetlens.llm.learn import ftrl, softmax, temperature
from fleetlens.llm.license_texts import FAMILIES

UNKNOWN = "unknown"
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
_LINE = re.compile(r"[^\n]+")
_MARK_WORDS = {"dnl", "rem"}  # comment marks that are words; all others hold no letter
LONG, WIDE, STEP = 80, 48, 16


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(words: list[str]) -> Counter:
    return Counter(words) + Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the lines of a text; a line of over LONG words in windows of WIDE words, STEP apart."""
    for line in _LINE.finditer(text):
        if line.end() - line.start() > 6 * LONG:
            spans = [m.span() for m in re.finditer(r"\S+", line.group())]
            if len(spans) > LONG:
                for k in range(0, len(spans) - WIDE + STEP, STEP):
                    w = spans[k:k + WIDE]
                    yield line.start() + w[0][0], line.start() + w[-1][1]
                continue
        yield line.span()


def blocks(text: str) -> Iterator[tuple[list[str], list[tuple[int, int, int]]]]:
    """(words, lines as (first word, start, end)) of every run of lines that hold a word, comment marks left out."""
    words: list[str] = []
    lines: list[tuple[int, int, int]] = []
    at = 0
    for line in text.split("\n"):
        w = words_of(line)
        if w:
            if w[0] in _MARK_WORDS:
                del w[0]
            lines.append((len(words), at, at + len(line)))
            words += w
        elif words:
            yield words, lines
            words, lines = [], []
        at += len(line) + 1
    if words:
        yield words, lines


@dataclass
class LicenseModel:
    classes: list[str]  # UNKNOWN last
    vocabulary: dict[str, int]
    weights: np.ndarray  # (vocabulary + 1) x classes, the last row constant
    temperature: float
    notices: list[tuple[int, Counter, int]]  # class, word bigrams, their number

    def __post_init__(self):
        self.marks = {g for g in self.vocabulary if " " in g}
        self.holders: dict[tuple[str, str], list[int]] = {}  # word bigram -> notices that hold it
        for i, (_, notice, _) in enumerate(self.notices):
            for p in notice:
                self.holders.setdefault(p, []).append(i)
        self.widest = max((n for _, _, n in self.notices), default=0) + 2

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        c = [(self.vocabulary[g], n) for g, n in grams(words).items() if g in self.vocabulary]
        at = np.array([i for i, _ in c] + [len(self.vocabulary)], int)
        x = np.array([n for _, n in c] + [0.0], float)
        x = np.minimum(x, 3)
        x /= max(4.0, x.sum()) ** 0.5  # words that no notice holds do not dilute it
        x[-1] = 1.0
        return at, x

    def classify(self, words: list[str]) -> tuple[int, float]:
        at, x = self.features(words)
        p = softmax(x @ self.weights[at] / self.temperature)
        k = int(np.argmax(p))
        return k, float(p[k])

    def similarity(self, k: int, words: list[str]) -> float:
        """Largest share of the bigrams of a notice of class k that the paragraph holds in one stretch of its length."""
        best = 0.0
        pairs = list(zip(words, words[1:]))
        for cls, notice, n in self.notices:
            if cls != k:
                continue
            hit = [i for i, p in enumerate(pairs) if p in notice]
            for a in hit:
                got = Counter(pairs[a:a + n + 2]) & notice
                best = max(best, sum(got.values()) / n)
        return best


    def stretches(self, words: list[str], least: float) -> list[tuple[float, int, int, int, int]]:
        """(similarity, bigrams of the notice, class, first, last bigram) of stretches that hold ``least`` of a notice.

        Of overlapping stretches of one notice the best.
        """
        pairs = list(zip(words, words[1:]))
        get = self.holders.get
        hits: dict[int, list[int]] = {}
        for i, holders in enumerate(map(get, pairs)):
            if holders:
                for k in holders:
                    hits.setdefault(k, []).append(i)
        out = []
        for k, at in hits.items():
            cls, notice, n = self.notices[k]
            need = least * n
            if len(at) < need:
                continue
            held: Counter = Counter()
            got, left = 0, 0
            best: tuple[int, int, int] | None = None  # bigrams held, first, last
            for i in at:
                p = pairs[i]
                held[p] += 1
                got += held[p] <= notice[p]
                while i - at[left] >= n + 2 or held[pairs[at[left]]] > notice[pairs[at[left]]]:
                    q = pairs[at[left]]
                    got -= held[q] <= notice[q]
                    held[q] -= 1
                    left += 1
                if got < need:
                    continue
                if best and best[2] >= at[left]:
                    if (got, at[left] - i) > (best[0], best[1] - best[2]):
                        best = got, at[left], i
                    continue
                if best:
                    out.append((best[0] / n, n, cls, best[1], best[2]))
                best = got, at[left], i
            if best:
                out.append((best[0] / n, n, cls, best[1], best[2]))
        return out


def _vary(text: str, rng: np.random.Generator) -> str:
    t = text.replace("{year}", str(rng.integers(1990, 2030))).replace("{holder}", rng.choice(["The Authors", "Example Corp", "A. Writer"]))
    w = t.split()
    if len(w) > 6:
        w = [x for x in w if rng.random() > 0.06]
    t = " ".join(w)
    return t.upper() if rng.random() < 0.1 else t


def train(background: list[str], seed: int = 11, copies: int = 40) -> LicenseModel:
    rng = np.random.default_rng(seed)
    classes = [*FAMILIES, UNKNOWN]
    unknown = len(classes) - 1
    notices = []
    vocabulary: dict[str, int] = {}
    for k, texts in enumerate(FAMILIES.values()):
        for t in texts:
            w = words_of(t.format(year="", holder=""))
            for g in grams(w):
                vocabulary.setdefault(g, len(vocabulary))
            pairs = Counter(zip(w, w[1:]))
            notices.append((k, pairs, max(1, sum(pairs.values()))))
    model = LicenseModel(classes, vocabulary, np.zeros((len(vocabulary) + 1, len(classes))), 1.0, notices)
    plain = [words_of(t) for t in background]
    plain = [w for w in plain if max(model.similarity(k, w) for k in range(unknown)) < 0.3] if plain else []
    rows, y = [], []
    for k, texts in enumerate(FAMILIES.values()):
        for t in texts:
            for _ in range(copies):
                w = words_of(_vary(t, rng))
                if plain and rng.random() < 0.4:  # a notice within other words
                    p = plain[rng.integers(len(plain))] * WIDE
                    w = p[:rng.integers(0, WIDE // 2)] + w + p[:rng.integers(0, WIDE // 2)]
                rows.append(model.features(w))
                y.append(k)
    single = sorted(g for g in vocabulary if " " not in g)
    for p in plain:
        rows.append(model.features(p))
        y.append(unknown)
    for _ in range(copies * 30):  # notice words in no order: common words alone are no notice
        rows.append(model.features([single[i] for i in rng.integers(0, len(single), rng.integers(1, 12))]))
        y.append(unknown)
    y = np.array(y)
    back = np.arange(len(y)) % 5 == 4
    model.weights = ftrl([r for r, b in zip(rows, back) if not b], y[~back], len(classes), len(vocabulary) + 1, alpha=0.5,
                         l1=1e-3, epochs=3)
    logits = np.array([x @ model.weights[at] for (at, x), b in zip(rows, back) if b])
    model.temperature = max(temperature(logits, y[back]), 0.05)
    return model


SPAN = "start int, end int, family string, score double, similarity double, confirmed boolean"


Row = tuple[int, int, str, float, float, bool]


def _line_spans(model: LicenseModel, text: str, least: float) -> list[Row]:
    """Lines of one text that are predicted to be a notice; of overlapping windows of a line the best."""
    known, marks = model.vocabulary, model.marks
    kept: list[Row] = []
    for a, z in paragraphs(text):
        w = words_of(text[a:z])
        if not any(f"{p} {q}" in marks for p, q in zip(w, w[1:]) if p in known and q in known):
            continue  # no notice bigram: the unknown class, and no notice that could confirm another
        k, p = model.classify(w)
        if model.classes[k] == UNKNOWN:
            continue
        s = model.similarity(k, w)
        row = (a, z, model.classes[k], p, s, s >= least)
        if kept and kept[-1][1] > a:
            if (row[5], row[4], row[3]) > (kept[-1][5], kept[-1][4], kept[-1][3]):
                kept[-1] = row
        else:
            kept.append(row)
    return kept


def _word_span(text: str, lines: list[tuple[int, int, int]], first: int, last: int) -> tuple[int, int]:
    """Start and end in the text of the words ``first`` to ``last`` of a block."""
    out = []
    for k, side in ((first, 0), (last, 1)):
        begin, a, z = lines[bisect_right(lines, k, key=lambda x: x[0]) - 1]
        line = text[a:z].lower()
        if len(line) != z - a:  # lower case of another length: the whole line
            out.append((a, z)[side])
            continue
        m = list(_WORD.finditer(line))
        out.append(a + m[k - begin + (m[0].group() in _MARK_WORDS)].span()[side])
    return out[0], out[1]


def _shared(a: tuple[int, int], b: tuple[int, int]) -> bool:
    """Whether two stretches share over half of the shorter one."""
    return 2 * (min(a[1], b[1]) - max(a[0], b[0]) + 1) > min(a[1] - a[0], b[1] - b[0]) + 1


def _block_spans(model: LicenseModel, text: str, least: float, rows: list[Row]) -> Iterator[Row]:
    """Confirmed notices in blocks of lines, apart from those that ``rows`` (by start) hold."""
    at = 0
    for words, lines in blocks(text):
        found = model.stretches(words, least)
        if not found:
            continue
        found.sort(key=lambda x: (-x[0], -x[1], x[3], x[2]))
        near: dict[int, list[tuple[int, int, int]]] = {}  # kept stretches by place: class, first, last

        def keep(cls: int, first: int, last: int) -> None:
            near.setdefault(first // model.widest, []).append((cls, first, last))

        def free(cls: int, first: int, last: int) -> bool:
            b = first // model.widest
            return not any(x <= last and first <= y if c == cls else _shared((x, y), (first, last))
                           for k in (b - 1, b, b + 1) for c, x, y in near.get(k, ()))

        placed = [(x, _word_span(text, lines, x[3], x[4] + 1)) for x in found]
        while at < len(rows) and rows[at][1] <= lines[0][1]:
            at += 1
        mine = []
        while at < len(rows) and rows[at][0] < lines[-1][2]:
            mine.append(rows[at])
            at += 1
        mine = [r for r in mine if r[5]]
        starts = [r[0] for r in mine]

        def row_of(a: int, z: int, cls: int) -> int | None:
            """The line notice of that class that shares text with a stretch."""
            k = bisect_right(starts, a) - 1
            for i in range(max(0, k), len(mine)):
                if mine[i][0] >= z:
                    return None
                if mine[i][1] > a and mine[i][2] == model.classes[cls]:
                    return i
            return None

        rest, stood = [], set()
        for x, (a, z) in placed:  # line notices stand first, by their best stretch
            i = row_of(a, z, x[2])
            if i is None:
                rest.append((x, a, z))
            elif i not in stood:
                stood.add(i)
                keep(x[2], x[3], x[4])
        for (s, _, cls, first, last), a, z in rest:
            if not free(cls, first, last):
                continue
            k, p = model.classify(words[first:last + 2])
            if k == cls:
                keep(cls, first, last)
                yield a, z, model.classes[cls], p, s, True


def spans(model: LicenseModel, text: str, least: float) -> Iterator[Row]:
    """Notices of one text by their start: lines predicted to be one, and confirmed stretches of blocks besides.

    An unconfirmed line that shares text with a confirmed stretch is left out.
    """
    rows = _line_spans(model, text, least)
    more = sorted(_block_spans(model, text, least, rows))
    if more:
        ends = list(accumulate((r[1] for r in more), max))
        starts = [r[0] for r in more]

        def covered(r: Row) -> bool:
            k = bisect_right(starts, r[1] - 1) - 1  # the last stretch that begins within or before the line
            return k >= 0 and ends[k] > r[0]
        rows = sorted([r for r in rows if r[5] or not covered(r)] + more)
    yield from rows


def background_sample(docs: DataFrame, text: str, doc_id: str, rows: int, max_chars: int) -> list[str]:
    """Paragraphs of at most ``rows`` documents (of up to ``max_chars`` characters), chosen by hashed id."""
    d = docs.select(docs[doc_id].alias("__id"), docs[text].alias("t")).where(
        F.length("t").between(1, max_chars) & F.col("__id").isNotNull())
    few = first_by_hash(d.select(F.lit(0).alias("all"), "__id"), "all", "__id", rows).select(F.col("__id").alias("__i")).distinct()
    got = d.join(F.broadcast(few), F.col("__id") == F.col("__i")).dropDuplicates(["__id"]).collect()
    out = []
    for r in sorted(got, key=lambda r: str(r["__id"])):
        out += [r["t"][a:z] for a, z in paragraphs(r["t"])][:20]
    return out


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.75, sample_rows: int = 200,
         max_chars: int = 20_000) -> DataFrame:
    """doc_id, notices array<struct<start, end, family, score, similarity, confirmed>> of every row of ``docs``.

    Whole texts, in pieces of lines; no shuffle of documents.  NULL and empty texts
    have no notice; repeated rows are reported each; an empty table gives an empty
    result.  Only the training's background is a sample (``sample_rows`` documents).
    """
    model = train(background_sample(docs, text, doc_id, sample_rows, max_chars))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the notices' vocabulary: fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        names = [x.split()[0] for x in SPAN.split(", ")]
        for b in batches:
            b["notices"] = [[dict(zip(names, s)) for s in spans(m, t, least)] if isinstance(t, str) else [] for t in b["__text"]]
            yield b[["doc_id", "notices"]]

    d = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("__text"))
    fields = ", ".join(f"{x.split()[0]}: {x.split()[1]}" for x in SPAN.split(", "))
    return map_pandas(d, run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, notices array<struct<{fields}>>")
