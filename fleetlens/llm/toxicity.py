"""Toxicity: a support vector machine on a gap-tolerant subsequence string kernel.

The kernel of two words counts their common character triples i < j < k, each
weighted by DECAY to the length it spans, so a triple that an inserted character
tears apart still counts.  Words are embedded through the kernel against landmark
words (Nystroem), and a squared-hinge machine separates insults from other words.
Since only documents are labelled, a toxic document is a bag whose best words are
taken as its insults, re-chosen a few times (multiple-instance learning).  A sentence is
as toxic as its best word window, a document as its two best windows; a logistic
fit on held-back documents turns these margins into a probability.

Spelled-out words (runs of single characters) are joined before scoring, and words
with marks inside are also read without them; neighbouring words that meet as inside
an insult are also read as one, which counts where it is more toxic than both.  Inserted letters are the kernel's
part: the machine learns from torn variants of the insults too, and the logistic fit
also sees held-back texts with torn insults and short pieces of texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import first_by_hash, map_pandas
from fleetlens.llm.learn import sigmoid

BITS = 16
DIMS = 1 << BITS
DECAY = 0.6
SPAN = 5  # a triple reaches over at most this many places further
WINDOW = 48  # longer words are read in windows of this many characters
EDGE = ".,;:!?|\"'()[]{}<>*#&%$-_/\\~^+="
EXCESS = 0.5  # by which such a pair exceeds both words' margins
TORN = 20  # torn variants of each insult that is learned
_RUN = re.compile(r"(.)\1{2,}", re.S)
MULT = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def words_of(text: str | None) -> list[str]:
    """Lower-case words without their edge marks; a run of three or more single characters becomes one word.

    A word with marks inside stands twice, as it is and without them.
    """
    out: list[str] = []
    run: list[str] = []
    for w in (text or "").lower().split():
        w = w.strip(EDGE) or w[:1]
        if len(w) == 1 and w.isalnum():
            run.append(w)
            continue
        if run:
            out.extend(["".join(run)] if len(run) > 2 else run)
            run = []
        out.append(w)
        if not w.isalnum():
            bare = "".join(filter(str.isalnum, w))
            if len(bare) > 3:
                out.append(bare)
    if run:
        out.extend(["".join(run)] if len(run) > 2 else run)
    return out


def junctions(words: Iterable[str]) -> set[str]:
    """Four characters around each place at which one of the words could be broken in two."""
    return {f"\x02{w}\x03"[k - 1:k + 3] for w in words for k in range(1, len(w))}


def joined(words: list[str], at: frozenset[str]) -> dict[str, tuple[str, str]]:
    """Two neighbouring words of a text as one -> the two, where they meet as one of ``at``."""
    return {a + b: (a, b) for a, b in zip(words, words[1:])
            if ((a[-2:] if len(a) > 1 else "\x02" + a) + (b[:2] if len(b) > 1 else b + "\x03")) in at}


def torn(word: str, rng: np.random.Generator) -> str:
    """The word with one letter inserted between two of its characters."""
    k = int(rng.integers(1, max(2, len(word))))
    return word[:k] + chr(97 + int(rng.integers(26))) + word[k:]


def windows(word: str) -> list[str]:
    """Windows of a word whose runs of one character are cut to two."""
    word = _RUN.sub(r"\1\1", word)
    if len(word) <= WINDOW:
        return [word]
    return [word[i:i + WINDOW] for i in range(0, len(word) - 8, WINDOW - 8)]


def triples(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word number, hashed triple, weight) of all words, one array pair per gap pattern."""
    c = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    a, b, d = c * MULT[0], c * MULT[1], c * MULT[2]
    for one in range(1, SPAN):
        for two in range(1, SPAN - one + 1):
            n = one + two
            if len(c) <= n:
                continue
            same = at[:-n] == at[n:]
            h = (a[:-n] ^ (b[one:len(c) - two] >> np.uint32(3))) * MULT[1] + d[n:]
            yield at[:-n][same], ((h ^ (h >> np.uint32(15))) * MULT[0] >> np.uint32(32 - BITS))[same], DECAY ** (n - 1)


def project(words: list[str], table: np.ndarray) -> np.ndarray:
    """Normalised kernel features of words times ``table`` (DIMS or DIMS x m)."""
    out = np.zeros((len(words), *table.shape[1:]))
    norm = np.full(len(words), 1e-12)
    for at, h, weight in triples(words):
        if table.ndim == 1:
            out += np.bincount(at, weights=table[h], minlength=len(words)) * weight
        elif len(at):
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            out[at[first]] += np.add.reduceat(table[h], first, axis=0) * weight
        norm += np.bincount(at, minlength=len(words)) * weight ** 2
    return out / np.sqrt(norm).reshape(-1, *[1] * (table.ndim - 1))


def feature_table(words: list[str]) -> np.ndarray:
    """DIMS x words: normalised kernel features, so that project(x, table) is the kernel matrix."""
    out = np.zeros((DIMS, len(words)), np.float32)
    norm = np.full(len(words), 1e-12)
    for at, h, weight in triples(words):
        np.add.at(out, (h, at), weight)
        norm += np.bincount(at, minlength=len(words)) * weight ** 2
    return out / np.sqrt(norm).astype(np.float32)


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.02, rounds: int = 30) -> np.ndarray:
    """Weights (last: constant) of a linear machine, by Newton steps over the rows within the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6

    def loss(v: np.ndarray) -> float:
        return float((weight * np.maximum(0.0, 1 - y * (x @ v)) ** 2).sum() + penalty @ v ** 2)

    now = loss(w)
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        xa, ca = x[inside], weight[inside]
        step = np.linalg.solve((xa * ca[:, None]).T @ xa + np.diag(penalty), (xa * ca[:, None]).T @ y[inside]) - w
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        w = w + size * step
        before, now = now, loss(w)
        if before - now < 1e-7 * before:
            break
    return w


@dataclass
class ToxicityModel:
    direction: np.ndarray  # DIMS: the landmarks' features times their coefficients
    offset: float
    calibration: np.ndarray  # constant, best, second best margin
    junctions: frozenset[str] = frozenset()  # of the learned insults

    def margins(self, words: list[str]) -> np.ndarray:
        return project(words, self.direction) + self.offset if words else np.zeros(0)

    def probability(self, two: np.ndarray) -> np.ndarray:
        return sigmoid(np.hstack([np.ones((len(two), 1)), np.clip(two, -3, 3)]) @ self.calibration)


class Scorer:
    """Two best margins of texts; margins of distinct words are kept up to a bound."""

    def __init__(self, model: ToxicityModel, keep: int = 200_000):
        self.model, self.keep, self.known = model, keep, {}

    def two_best(self, texts: list[str]) -> np.ndarray:
        return self.of_words([words_of(t) for t in texts])

    def of_words(self, texts: list[list[str]]) -> np.ndarray:
        """Two best margins of texts given as words; a pair of words counts where it exceeds both."""
        out = np.full((len(texts), 2), -3.0)
        bags, pairs = [set(w) for w in texts], [joined(w, self.model.junctions) for w in texts]
        new = list(set().union(*bags, *pairs) - self.known.keys()) if bags else []
        if len(self.known) + len(new) > self.keep:
            self.known = {}
            new = list(set().union(*bags, *pairs))
        for k in range(0, len(new), 20_000):
            part = new[k:k + 20_000]
            cut = [windows(w) for w in part]
            m = self.model.margins([w for c in cut for w in c])
            ends = np.cumsum([len(c) for c in cut])
            best = np.maximum.reduceat(m, np.r_[0, ends[:-1]]) if len(m) else m
            self.known.update(zip(part, best.tolist()))
        known = self.known
        for i, (bag, pair) in enumerate(zip(bags, pairs)):
            if bag:
                m = sorted(map(known.__getitem__, bag))[-2:]
                if pair:
                    top = max(pair, key=known.__getitem__)
                    a, b = pair[top]
                    if known[top] > max(known[a], known[b]) + EXCESS:  # in place of its two words
                        m = sorted([known[top], *(known[w] for w in bag if w != a and w != b)])[-2:]
                out[i, 0] = m[-1]
                if len(m) > 1:
                    out[i, 1] = m[0]
        return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ w)
        v = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * v[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return w


def train(texts: list[str], y: np.ndarray, landmarks: int = 384, others: int = 12_000, rounds: int = 3,
          seed: int = 3) -> ToxicityModel | None:
    """Fit on labelled texts (in memory: a bounded sample).  None without both labels."""
    if not ((y == 1).any() and (y == 0).any()):
        return None
    bags = [set(x for w in words_of(t) for x in windows(w)) for t in texts]
    back = np.arange(len(texts)) % 4 == 3
    if len(set(y[back])) < 2 or len(set(y[~back])) < 2:
        back[:] = False
    df = (Counter(), Counter())
    for bag, label, b in zip(bags, y, back):
        if not b:
            df[int(label)].update(bag)
    n0, n1 = max(1, int((y[~back] == 0).sum())), int((y[~back] == 1).sum())
    rate = {w: (c + 0.5) / (n1 + 1) / ((df[0][w] + 0.5) / (n0 + 1)) for w, c in df[1].items()}
    gain = {w: c * np.log(rate[w]) for w, c in df[1].items() if rate[w] > 3}
    rng = np.random.default_rng(seed)
    clean = sorted(df[0])
    usual = [clean[i] for i in rng.permutation(len(clean))[:others]]
    usual += [w for w, _ in sorted(df[0].items(), key=lambda x: (-x[1], x[0]))[:2000]]
    usual = list(dict.fromkeys(usual))
    seeds = sorted(gain, key=lambda w: (-gain[w], w))[:max(40, landmarks)]
    seeds = [w for w in seeds if gain[w] >= min(6.0, gain[seeds[0]])] if seeds else sorted(df[1])[:landmarks]
    # Only words that stand out are torn: variants of a word that is toxic by chance would be false alarms.
    most = max(gain.values(), default=0.0)
    sure = [w for w in seeds if len(w) > 3 and not df[0][w] and w in gain and gain[w] >= most / 4]
    variants = [torn(w, rng) for w in sure for _ in range(TORN)]
    variants = [w for w in dict.fromkeys(variants) if not df[0][w]]
    toxic = [*seeds, *(w for w in variants if w not in df[1])]
    # Words of toxic documents are unlabelled: no evidence against them, so the other side is clean documents' words only.
    model = None
    marks = list(dict.fromkeys(seeds[:landmarks // 2] + usual[:landmarks - min(len(seeds), landmarks // 2)]))
    table = feature_table(marks)
    kmm = project(marks, table)
    val, vec = np.linalg.eigh((kmm + kmm.T) / 2 + 1e-6 * np.eye(len(marks)))
    root = vec / np.sqrt(np.maximum(val, 1e-6)) @ vec.T
    z_usual = project(usual, table) @ root
    for turn in range(rounds):
        z = np.vstack([project(toxic, table) @ root, z_usual])
        sign = np.r_[np.ones(len(toxic)), -np.ones(len(usual))]
        # A word weighs as many documents as it is seen in on its side.
        weight = np.sqrt([float(max(1, df[1][x])) for x in toxic] + [float(max(1, df[0][x])) for x in usual])
        w = squared_hinge(z, sign, weight)
        model = ToxicityModel((table @ (root @ w[:-1]).astype(np.float32)).astype(np.float64), float(w[-1]), np.zeros(3))
        if turn == rounds - 1:
            break
        every = sorted(set().union(*(b for b, label, h in zip(bags, y, back) if label == 1 and not h)))
        margin = dict(zip(every, model.margins(every).tolist()))
        chosen = set(seeds) | set(variants)
        for bag, label, h in zip(bags, y, back):
            if label == 1 and not h and bag:
                best = max(bag, key=lambda x: (margin[x], x))
                chosen |= {x for x in bag if margin[x] > 0.5 and not df[0][x]} | ({best} if margin[best] > -0.5 and df[0][best] <= 1 else set())
        toxic = sorted(chosen)
        hard = model.margins(clean)
        extra = [clean[i] for i in np.argsort(-hard, kind="stable")[:2000]]
        have = set(usual)
        extra = [x for x in extra if x not in have]
        usual += extra
        z_usual = np.vstack([z_usual, project(extra, table) @ root])
    use = back if back.any() else np.ones(len(y), bool)
    model.junctions = frozenset(junctions([*sure, *variants]))
    scorer, rows, of = Scorer(model), [], []
    for t, label in zip([t for t, u in zip(texts, use) if u], y[use]):
        words = words_of(t)
        margin = dict(zip(set(words), model.margins(list(set(words))).tolist()))
        if label:  # as it is, with its insults torn, and a piece around one insult, whole and torn
            odd = [torn(w, rng) if margin[w] > 0 and len(w) > 3 else w for w in words]
            at = max(range(len(words)), key=lambda k: margin[words[k]], default=0)
            piece = slice(max(0, at - 5), at + 5)
            found = bool(words) and margin[words[at]] > 0
            more = [words, odd, words[piece], odd[piece]] if found else [words]
        else:
            more = [words, *(words[at:at + 10] for at in rng.integers(max(1, len(words) - 10), size=3))]
        rows += more
        of += [label] * len(more)
    model.calibration = _logistic(np.clip(scorer.of_words(rows), -3, 3), np.array(of))
    return model


def sample(docs: DataFrame, labels: DataFrame, may_learn, label: str, doc_id: str, text: str, per_label: int,
           max_chars: int) -> list:
    """At most ``per_label`` labelled rows of each label (texts of up to ``max_chars``), by hashed id."""
    y = (labels.select(labels[doc_id].alias("__lid"), labels[label].cast("int").alias("y"))
         .where("__lid is not null and y in (0, 1)").groupBy("__lid").agg(F.max("y").alias("y")).where(may_learn("__lid")))
    few = first_by_hash(y, "y", "__lid", per_label)
    d = docs.select(docs[doc_id].alias("__id"), docs[text].alias("__text")).where(F.length("__text") <= max_chars)
    rows = d.join(F.broadcast(few), F.col("__id") == F.col("__lid")).select("__id", "y", "__text").dropDuplicates(["__id"])
    return sorted(rows.collect(), key=lambda r: (str(r["__id"])[::-1], r["__text"]))


def classify(docs: DataFrame, labels: DataFrame, may_learn, label: str = "toxic", doc_id: str = "doc_id",
             text: str = "text", per_label: int = 1500, max_chars: int = 20_000) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``; whole texts, no shuffle.

    ``may_learn``: from a column name to the condition under which that id's label may
    be read.  The fit uses at most ``per_label`` documents of each label.  Without
    both labels every score is 0.  NULL and empty texts have no word: the model's
    least score.  Repeated rows are scored each; an empty table gives an empty result.
    """
    rows = sample(docs, labels, may_learn, label, doc_id, text, per_label, max_chars)
    model = train([r["__text"] for r in rows], np.array([r["y"] for r in rows], int))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS numbers, whatever the input

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        scorer = Scorer(m) if m is not None else None
        for b in batches:
            score = np.zeros(len(b))
            texts = [t if isinstance(t, str) else "" for t in b["__text"]]
            if scorer is not None:
                for k in range(0, len(texts), 64):
                    score[k:k + 64] = m.probability(scorer.two_best(texts[k:k + 64]))
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": score, "predicted": (score >= 0.5).astype("int32")})

    d = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("__text"))
    return map_pandas(d, run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
