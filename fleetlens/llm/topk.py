"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into levels, levels into blocks.  Every query first
meets the blocks of the longest vectors; its k-th best product there, divided by
its own length, is the least length that a better partner can have.  A level
whose longest vector is shorter is left out for that query.  In a block that
stays, the local cosine threshold (needed product over the longest possible one)
chooses how the block is searched: a high threshold by the range that the query's
strongest coordinate allows (Cauchy-Schwarz on the other coordinates), a low one
by length order.  All products of what remains are computed exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import cut

#: Ratio of the longest to the shortest vector of a level.
RATIO = 1.02
#: From this cosine threshold on, a block is searched by coordinate.
BY_COORDINATE = 0.6
RESULT = "query_id long, vec_id long, score long"


def quantised(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", scale: int = 256) -> DataFrame:
    """(vec_id, v array<long>, norm double, dim, level): floor(scale * x) of every usable vector.

    Left out: rows without an id, NULL or empty vectors, and vectors that hold a NULL or
    non-finite component.
    """
    x = df.select(df[vec_id].cast("long").alias("vec_id"), df[vector].cast("array<double>").alias("x"))
    good = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    x = x.where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & good)
    v = x.select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
    return (v.withColumn("norm", norm).withColumn("dim", F.size("v"))
            .withColumn("level", F.when(F.col("norm") > 0, F.floor(F.log("norm") / math.log(RATIO)).cast("int"))
                        .otherwise(F.lit(-1))))


def _pack(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
    """One block: its vectors by falling length, equal lengths by id."""
    g = g.sort_values(["norm", "vec_id"], ascending=[False, True])
    m = np.stack(g["v"].to_numpy()).astype(np.int64)
    return pd.DataFrame([[*key, g["vec_id"].to_numpy(np.int64).tobytes(), m.tobytes(),
                          g["norm"].to_numpy(np.float64).tobytes()]])


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """(dim, level, blk, n_blk, ids, vals, norms): blocks of about ``size`` vectors.

    A level of any size is dealt over as many blocks as it needs, by hashed id.
    """
    counts = vectors.groupBy("dim", "level").agg(F.ceil(F.count("*") / size).cast("int").alias("n_blk"))
    dealt = (vectors.join(F.broadcast(counts), ["dim", "level"])  # a row per level: bounded by the range of doubles
             .withColumn("blk", F.pmod(F.xxhash64("vec_id"), F.col("n_blk")).cast("int")))
    return dealt.groupBy("dim", "level", "blk", "n_blk").applyInPandas(
        _pack, "dim int, level int, blk int, n_blk int, ids binary, vals binary, norms binary")


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer products; by floating point where every partial sum is a whole number below 2^53."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top < 2 ** 52:
        return np.rint(q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def search_block(qid, q, qnorm, need, ids, c, norms, k):
    """Best k of one block for each query.  need: length that a useful partner must reach (-inf: any)."""
    longest, unit, order = norms[0], None, {}
    upto = np.searchsorted(-norms, -(need * (1 - 1e-9)), side="right")  # norms fall
    upto[~(need > 0)] = len(norms)
    local = np.where(need > 0, need / max(longest, 1e-300), 0.0)
    plain = np.flatnonzero((upto > 0) & (local < BY_COORDINATE))
    for part in np.array_split(plain, max(1, len(plain) * len(ids) // 4_000_000 + 1)):
        if len(part):
            s = _exact(q[part], c[:upto[part].max()])
            for row, j in enumerate(part):
                n = upto[j]
                own = ids[:n] != qid[j]
                sc, cand = s[row, :n], ids[:n]
                if not own.all():
                    sc, cand = sc[own], cand[own]
                at = _best(sc, cand, k)
                yield qid[j], cand[at], sc[at]
    for j in np.flatnonzero((upto > 0) & (local >= BY_COORDINATE)):
        if unit is None:
            unit = c / np.maximum(norms, 1e-300)[:, None]
        u = q[j] / qnorm[j]
        f = int(np.argmax(np.abs(u)))
        if f not in order:
            by = np.argsort(unit[:, f], kind="stable")
            order[f] = by, unit[by, f]
        by, sorted_f = order[f]
        t = min(1.0, local[j] * (1 - 1e-9))
        mid, wide = u[f] * t, math.sqrt(max(0.0, (1 - u[f] ** 2) * (1 - t * t)))
        # The range of cosines t..1, not t alone: it reaches to the query's own direction.
        hi = 1.0 if u[f] >= t else mid + wide
        lo = -1.0 if u[f] <= -t else mid - wide
        at = by[np.searchsorted(sorted_f, lo - 1e-9):np.searchsorted(sorted_f, hi + 1e-9, side="right")]
        at = at[(at < upto[j]) & (ids[at] != qid[j])]
        if len(at):
            s = _exact(q[j:j + 1], c[at])[0]
            b = _best(s, ids[at], k)
            yield qid[j], ids[at][b], s[b]


def _meet(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for r in df.itertuples(index=False):
                ids, norms = np.frombuffer(r.ids, np.int64), np.frombuffer(r.norms, np.float64)
                c = np.frombuffer(r.vals, np.int64).reshape(len(ids), r.dim)
                qid, qnorm = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.q_norms, np.float64)
                q, need = np.frombuffer(r.q_vals, np.int64).reshape(len(qid), r.dim), np.frombuffer(r.q_need, np.float64)
                for a, b, s in search_block(qid, q, qnorm, need, ids, c, norms, k):
                    out.append((np.full(len(b), a), b, s))
            if out:
                yield pd.DataFrame({n: np.concatenate([o[i] for o in out]) for i, n in enumerate(("query_id", "vec_id", "score"))})
    return run


def _pack_queries(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("vec_id")
    m = np.stack(g["v"].to_numpy()).astype(np.int64)
    need = g["need"].to_numpy(np.float64)
    return pd.DataFrame([[key[0], float(np.min(need)), g["vec_id"].to_numpy(np.int64).tobytes(), m.tobytes(),
                          g["norm"].to_numpy(np.float64).tobytes(), need.tobytes()]])


def query_blocks(queries: DataFrame, size: int) -> DataFrame:
    """Queries of like need, ``size`` to a block: (dim, least, q_ids, q_vals, q_norms, q_need)."""
    near = F.when(F.col("need") > 0, F.floor(F.log("need") / math.log(RATIO)).cast("int")).otherwise(F.lit(-1))
    x = queries.withColumn("near", near)
    counts = x.groupBy("dim", "near").agg(F.ceil(F.count("*") / size).cast("int").alias("n_q"))
    dealt = (x.join(F.broadcast(counts), ["dim", "near"])
             .withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.col("n_q")).cast("int")))
    return dealt.groupBy("dim", "near", "qb").applyInPandas(
        _pack_queries, "dim int, least double, q_ids binary, q_vals binary, q_norms binary, q_need binary")


def _search(qb: DataFrame, packed: DataFrame, levels: list[tuple[int, int, int]], k: int) -> DataFrame:
    """Query blocks against the blocks of ``levels`` (dim, level, n_blk) that can hold a partner for them."""
    spark = packed.sparkSession
    lv = spark.createDataFrame(levels or [(-1, -1, 0)], "dim int, level int, n_blk int")
    longest = F.when(F.col("level") == -1, 0.0).otherwise(F.exp((F.col("level") + 1) * math.log(RATIO))) * (1 + 1e-9)
    sent = (qb.join(F.broadcast(lv), "dim").where((F.col("least") <= 0) | (longest >= F.col("least")))
            .where("n_blk > 0").withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("n_blk") - 1))).drop("n_blk"))
    return (sent.join(packed.drop("n_blk"), ["dim", "level", "blk"])
            .select("dim", "ids", "vals", "norms", "q_ids", "q_vals", "q_norms", "q_need")
            .mapInPandas(_meet(k), RESULT))


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, vector: str = "embedding",
          vec_id: str = "vec_id", block: int = 4096, query_block: int = 512, first: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of every query's k best partners.

    ``is_query``: condition on ``vec_id`` that marks the queries; every usable vector
    of the query's dimension but those under its own id is a candidate.  If an id
    repeats, its smallest vector is the query and all its rows are candidates of
    others.  Ties go to smaller ids.  A query with fewer partners gets them all; an
    empty table gives an empty result.  ``first`` vectors at least, the longest ones,
    set each query's threshold; all others are then searched under it.
    """
    v = cut(quantised(vectors, vector, vec_id, scale))
    packed = cut(blocks(v, block))
    meta = v.groupBy("dim", "level").agg(F.count("*").alias("n"), F.ceil(F.count("*") / block).cast("int").alias("n_blk")).collect()
    head, rest, seen = [], [], {}
    for r in sorted(meta, key=lambda r: (r["dim"], -r["level"])):
        (head if seen.get(r["dim"], 0) < first else rest).append((r["dim"], r["level"], r["n_blk"]))
        seen[r["dim"]] = seen.get(r["dim"], 0) + r["n"]
    q = (v.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "norm", "dim")).alias("s"))
         .select("vec_id", "s.v", "s.norm", "s.dim"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    opened = cut(top(_search(query_blocks(q.withColumn("need", F.lit(float("-inf"))), query_block), packed, head, k)))
    least = opened.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("theta"))
    need = F.when(F.col("theta").isNull() | (F.col("norm") == 0) | (F.col("theta") <= 0), F.lit(float("-inf"))).otherwise(
        F.col("theta") / F.col("norm"))
    later = q.join(least, "vec_id", "left").withColumn("need", need).drop("theta")
    found = opened.select("query_id", "vec_id", "score").unionByName(
        _search(query_blocks(later, query_block), packed, rest, k))
    return top(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
