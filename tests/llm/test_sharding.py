import collections

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import sharding

NAMES = [f"shard-{k}" for k in range(7)]


def test_every_shard_owns_equally_many_slots():
    n = collections.Counter(sharding.fill_table(NAMES, 211))
    assert sum(n.values()) == 211 and max(n.values()) - min(n.values()) <= 1


def test_turns_follow_preferences():
    """Brute force: simulate the claims from whole preference lists."""
    size, names = 101, sorted(NAMES)
    prefs = [[(sharding._digest(f"{s}:offset") + j * (sharding._digest(f"{s}:skip") % (size - 1) + 1)) % size for j in range(size)]
             for s in names]
    assert all(sorted(p) == list(range(size)) for p in prefs)
    free, owner = set(range(size)), {}
    for t in range(size):
        s = next(x for x in prefs[t % len(names)] if x in free)
        free.discard(s)
        owner[s] = names[t % len(names)]
    assert [owner[k] for k in range(size)] == sharding.fill_table(NAMES, size)


def test_losing_a_shard_moves_few_slots():
    before, after = sharding.fill_table(NAMES, 2053), sharding.fill_table(NAMES[:-1], 2053)
    share = sharding.moved(before, after)
    assert 1 / 7 - 0.01 <= share < 0.35


@pytest.mark.parametrize("shards,size", [(NAMES, 100), ([], 101), (["a", "a"], 101), (NAMES, 1_000_033)])
def test_bad_tables_are_refused(shards, size):
    with pytest.raises(ValueError):
        sharding.fill_table(shards, size)


def test_messy_rows_are_all_placed(messy, nothing):
    out = sharding.place(messy, sharding.document_key(messy), NAMES, 211)
    assert out.count() == messy.count() and set(messy.columns) == set(out.columns)
    assert out.where("shard is null or shard = 'clash'").count() == 0
    assert out.where("doc_id = 1").select("slot").distinct().count() == 1
    assert sharding.place(nothing, F.col("doc_id"), NAMES, 211).count() == 0


def test_written_shards_hold_their_rows(spark, messy, tmp_path):
    out = sharding.place(messy, sharding.document_key(messy), NAMES, 211).cache()
    sharding.write_shards(out.drop("label"), str(tmp_path / "s"), files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == out.count()
    assert {tuple(r) for r in back.select("doc_id", "shard").collect()} == {tuple(r) for r in out.select("doc_id", "shard").collect()}
