"""Hard negatives by exact integer products in a residue number system.

The whole-number vectors are reduced modulo a few small odd primes.  Each residue
matrix pair is multiplied in float32: centred residues are so small that every partial
sum stays below 2^24 and is exact in any order.  Chinese remaindering (mixed radix with
centred digits) turns the residues of a product back into the signed score; as many
primes are taken as the largest possible score needs.  A first pass, within labels, finds
each anchor's positives; a second one, over all rows, the best rows of other labels in
each positive's score window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import cut

#: Float32 holds whole numbers up to here.
EXACT = 1 << 24
#: Columns that are summed in float32 at once.
WIDTH = 1024
#: Scores that a task holds at once.
SCORES = 4_000_000


# ------------------------------------------------------------------ residue number system
def primes(width: int, bound: int) -> list[int]:
    """Odd primes, largest first, whose products of ``width`` centred residues are exact and that tell
    whole numbers from -bound to bound apart."""
    n = 2 * int((EXACT / max(1, width)) ** 0.5)
    sieve = np.ones(n + 1, bool)
    for k in range(2, int(n ** 0.5) + 1):
        sieve[k * k::k] = False
    out, product = [], 1
    for p in np.flatnonzero(sieve)[:2:-1].tolist():
        if width * (p // 2) ** 2 >= EXACT:
            continue
        out.append(p)
        product *= p
        if product > 2 * bound:
            return out
    raise ValueError("scores are too large for this number system")


def residues(m: np.ndarray, p: int) -> np.ndarray:
    """Residues of smallest absolute value, as float32."""
    h = p // 2
    return ((m + h) % p - h).astype(np.float32)


def signed(parts: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """The whole numbers with these residues, within half the product of the moduli around 0.

    Mixed radix: each digit is what the digits before leave over, centred.  The sum is that
    of the number modulo 2^64, so it is right whenever the number itself fits in 64 bits.
    """
    digits: list[np.ndarray] = []
    total, weight = np.zeros(parts[0].shape, np.int64), 1
    for part, p in zip(parts, moduli):
        rest, w = part.astype(np.int64), 1
        for d, q in zip(digits, moduli):
            rest -= d * w
            w = w * q % p
            rest %= p
        d = (rest * pow(w, -1, p) + p // 2) % p - p // 2
        digits.append(d)
        total += d * np.int64((weight + 2 ** 63) % 2 ** 64 - 2 ** 63)
        weight *= p
    return total


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two int64 matrices, exactly (if they fit in 64 bits)."""
    width = a.shape[1]
    bound = width * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    moduli, parts = primes(min(width, WIDTH), bound), []
    for p in moduli:
        ra, rb = residues(a, p), residues(b, p)
        s = np.zeros((len(a), len(b)), np.int64)
        for k in range(0, width, WIDTH):
            s += (ra[:, k:k + WIDTH] @ rb[:, k:k + WIDTH].T).astype(np.int64) % p
        parts.append(s)
    return signed(parts, moduli)


# ------------------------------------------------------------------ rows and blocks
def prepared(df: DataFrame, label: Column | str = "label", vector: str = "embedding", vec_id: str = "vec_id",
             scale: int = 256) -> DataFrame:
    """(vec_id, label string, v array<long>, dim): floor(scale * x) of every component.

    Left out: rows without an id or label, and NULL or empty vectors or those that hold a
    NULL or non-finite component.
    """
    label = F.col(label) if isinstance(label, str) else label
    x = df.select(df[vec_id].cast("long").alias("vec_id"), label.cast("string").alias("label"),
                  df[vector].cast("array<double>").alias("x"))
    good = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    x = x.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0) & good)
    return x.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v"),
                    F.size("x").alias("dim"))


def _packed(key: tuple, g: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    g = g.sort_values(["vec_id", "label"], kind="stable")
    return g, np.stack(g["v"].to_numpy()).astype(np.int64)


def _pack(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
    """One block of candidates by rising id; labels as numbers of the block's own list."""
    g, m = _packed(key, g)
    names, code = np.unique(g["label"].to_numpy(str), return_inverse=True)
    return pd.DataFrame([[*key, g["vec_id"].to_numpy(np.int64).tobytes(), m.tobytes(), names.tolist(),
                          code.astype(np.int32).tobytes()]])


def blocks(rows: DataFrame, size: int, by: list[str]) -> DataFrame:
    """Blocks of about ``size`` rows of equal ``by``, dealt by hashed id: (*by, blk, ids, vals, names, codes)."""
    n = rows.groupBy(*by).agg(F.ceil(F.count("*") / size).cast("int").alias("n_blk"))
    dealt = rows.join(n, by).withColumn("blk", F.pmod(F.xxhash64("vec_id"), F.col("n_blk")).cast("int"))
    kinds = {"dim": "int", "label": "string"}
    return dealt.groupBy(*by, "blk").applyInPandas(
        _pack, ", ".join(f"{c} {kinds[c]}" for c in by) + ", blk int, ids binary, vals binary, names array<string>, codes binary")


def _pack_anchors(by: list[str]):
    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g, m = _packed(key, g)
        return pd.DataFrame([[*key, g["vec_id"].to_numpy(np.int64).tobytes(), m.tobytes(), g["label"].tolist(),
                              [list(map(int, w)) for w in g["want"]]]])
    return run


def anchor_blocks(anchors: DataFrame, size: int, by: list[str]) -> DataFrame:
    """Blocks of about ``size`` anchors (vec_id, label, v, dim, want): (*by, qb, q_ids, q_vals, q_labels, q_want)."""
    n = anchors.groupBy(*by).agg(F.ceil(F.count("*") / size).cast("int").alias("n_q"))
    dealt = anchors.join(n, by).withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("n_q")).cast("int"))
    kinds = {"dim": "int", "label": "string"}
    return dealt.groupBy(*by, "qb").applyInPandas(
        _pack_anchors(by), ", ".join(f"{c} {kinds[c]}" for c in by)
        + ", qb int, q_ids binary, q_vals binary, q_labels array<string>, q_want array<array<long>>")


def _meet(find, names: list[str]):
    """Anchor blocks beside candidate blocks; ``find`` takes what a slice of a pair holds and yields result rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for r in df.itertuples(index=False):
                ids, qid = np.frombuffer(r.ids, np.int64), np.frombuffer(r.q_ids, np.int64)
                c, q = np.frombuffer(r.vals, np.int64).reshape(len(ids), -1), np.frombuffer(r.q_vals, np.int64).reshape(len(qid), -1)
                number = {n: k for k, n in enumerate(r.names)}
                code, own = np.frombuffer(r.codes, np.int32), np.array([number.get(x, -1) for x in r.q_labels], np.int32)
                step, out = max(1, SCORES // len(ids)), []
                for a in range(0, len(qid), step):
                    s = products(q[a:a + step], c)
                    out += find(s, qid[a:a + step], own[a:a + step], r.q_want[a:a + step], ids, code)
                if out:
                    yield pd.DataFrame({n: np.concatenate([o[k] for o in out]) for k, n in enumerate(names)})
    return run


def _positives(k: int):
    def find(s, qid, own, _, ids, code):
        for j, row in enumerate(s):
            at = np.flatnonzero((code == own[j]) & (ids != qid[j]))
            if len(at) > 4 * k:
                at = at[row[at] >= np.partition(row[at], len(at) - k)[len(at) - k]]
            at = at[np.lexsort((ids[at], -row[at]))[:k]]
            yield np.full(len(at), qid[j]), ids[at], row[at]
    return find


def _negatives(k: int, low: int, high: int):
    """Of each wanted positive score p the best k scores s of other labels with low*p <= 100*s <= high*p."""
    def find(s, qid, own, want, ids, code):
        for j, row in enumerate(s):
            windows = [(int(p), -(-low * int(p) // 100), high * int(p) // 100) for p in want[j]]
            other = np.flatnonzero((code != own[j]) & (row >= min(w[1] for w in windows)) & (row <= max(w[2] for w in windows)))
            other = other[np.argsort(-row[other], kind="stable")]  # ids rise, so ties stay by id
            falling = -row[other]
            for p, least, most in windows:
                a = np.searchsorted(falling, -most, side="left")
                at = other[a:min(np.searchsorted(falling, -least, side="right"), a + k)]
                if len(at):
                    yield np.full(len(at), qid[j]), np.full(len(at), p), ids[at], row[at]
    return find


def _product(q: DataFrame, c: DataFrame, by: list[str], find, schema: str) -> DataFrame:
    names = [x.split(" ")[0] for x in schema.split(", ")]
    return (q.join(c, by).select("ids", "vals", "names", "codes", "q_ids", "q_vals", "q_labels", "q_want")
            .mapInPandas(_meet(find, names), schema))


def mine(vectors: DataFrame, is_anchor, label: Column | str = "label", positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, scale: int = 256, vector: str = "embedding", vec_id: str = "vec_id",
         block: int = 4096, anchor_block: int = 1024) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor``: condition on ``vec_id``.  An anchor's positives are its ``positives`` best
    rows of the same label under another id; each positive's negatives the ``negatives`` best
    rows of other labels whose score lies within ``low`` to ``high`` percent of the
    positive's.  Ties go to smaller ids.  Vectors of another dimension than the anchor's
    take no part for it.  If an id repeats, its smallest (label, vector) is the anchor, and
    all its rows can be positives or negatives of others (the anchor's own id can only be a
    negative).  An anchor without positives, and a positive without a row in its window, give
    no row; an empty table gives none.
    """
    rows = cut(prepared(vectors, label, vector, vec_id, scale))
    anchors = (rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v", "dim")).alias("s"))
               .select("vec_id", "s.label", "s.v", "s.dim"))
    within = _product(anchor_blocks(anchors.withColumn("want", F.array().cast("array<long>")), anchor_block, ["dim", "label"]),
                      blocks(rows, block, ["dim", "label"]), ["dim", "label"], _positives(positives),
                      "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    chosen = cut(within.withColumn("nr", F.row_number().over(best)).where(F.col("nr") <= positives).drop("nr"))
    wanted = anchors.join(chosen.groupBy(F.col("anchor_id").alias("vec_id"))
                          .agg(F.collect_set("positive_score").alias("want")), "vec_id")  # ``positives`` scores at most
    found = _product(anchor_blocks(wanted, anchor_block, ["dim"]), blocks(rows, block, ["dim"]), ["dim"],
                     _negatives(negatives, low, high), "anchor_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_score").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return (chosen.join(ranked, ["anchor_id", "positive_score"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
