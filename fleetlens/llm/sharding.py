"""Sharding through a permutation-filled lookup table.

Every shard ranks the slots of a table of prime size by its own permutation
``(offset + j * skip) mod size``.  The shards take turns, each claiming the best
slot of its ranking that is still free, until the table is full; so shards hold
equally many slots (give or take one), and adding or removing a shard moves few
of them.  A row's place is one hash and one table look-up.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import digest60

#: Above this the table is refused: it is broadcast, so its size must stay bounded.
MAX_TABLE = 1_000_003


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def fill_table(shards: list[str], size: int) -> list[str]:
    """Owner of each of ``size`` slots.  ``shards`` are ranked by name; names must be distinct."""
    if not _is_prime(size) or size > MAX_TABLE:
        raise ValueError(f"table size must be a prime of at most {MAX_TABLE}")
    names = sorted(set(shards))
    if not names or len(names) != len(shards) or len(names) > size:
        raise ValueError("shards must be distinct, at least one, and at most as many as slots")
    nxt = [_digest(f"{s}:offset") % size for s in names]
    skip = [_digest(f"{s}:skip") % (size - 1) + 1 for s in names]
    owner: list[str | None] = [None] * size
    for turn in range(size):
        k = turn % len(names)
        while owner[nxt[k]] is not None:
            nxt[k] = (nxt[k] + skip[k]) % size
        owner[nxt[k]] = names[k]
    return owner


def table_frame(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """(slot, shard) rows of the filled table: at most ``MAX_TABLE`` of them."""
    return spark.createDataFrame(list(enumerate(fill_table(shards, size))), "slot long, shard string")


def place(df: DataFrame, key: Column, shards: list[str], size: int,
          slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with the slot and shard of every row; no shuffle.

    Rows with equal keys share a shard.  The result columns replace columns of
    those names.  A NULL key is placed as the empty text; an empty table gives an
    empty table.  The broadcast side has ``size`` rows (checked, at most MAX_TABLE).
    """
    lookup = table_frame(df.sparkSession, shards, size).select(
        F.col("slot").alias("__slot"), F.col("shard").alias("__shard"))
    keep = [c for c in df.columns if c.lower() not in (slot_col.lower(), shard_col.lower())]
    at = F.pmod(digest60(F.coalesce(key.cast("string"), F.lit(""))), F.lit(size))
    return (df.select(*[df[c] for c in keep], at.alias("__at"))
            .join(F.broadcast(lookup), F.col("__at") == F.col("__slot"))
            .select(*[F.col(f"`{c}`") for c in keep], F.col("__slot").alias(slot_col), F.col("__shard").alias(shard_col)))


def document_key(df: DataFrame) -> Column:
    """Key of a document row: its id; rows without one are spread by their other short columns."""
    other = [F.coalesce(df[c].cast("string"), F.lit("")) for c in ("lang", "source", "n_chars") if c in df.columns]
    return F.coalesce(df["doc_id"].cast("string"), F.concat_ws("|", F.lit("-"), *other))


def moved(before: list[str], after: list[str]) -> float:
    """Share of slots whose owner differs between two tables of the same size."""
    return sum(a != b for a, b in zip(before, after, strict=True)) / len(before)


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1, shard_col: str = "shard",
                 slot_col: str = "slot") -> None:
    """One folder per shard; a large shard is written by ``files_per_shard`` tasks."""
    (placed.repartition(F.col(shard_col), F.col(slot_col) % files_per_shard)
     .write.mode("overwrite").partitionBy(shard_col).parquet(path))
