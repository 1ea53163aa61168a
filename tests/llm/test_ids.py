"""Ids beside NULLs keep their values in every operator, and odd inputs do not crash one."""
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import decontaminate, language, licenses, lm, neardup, quality, sharding, toxicity
from fleetlens.llm.common import id_crc, ready

BIG = [2 ** 60 + 1, 2 ** 60 + 3, 2 ** 60 + 5, -(2 ** 60) - 7]
TEXT = "the quick brown fox jumps over the lazy dog near the river bank"


@pytest.fixture(scope="module")
def big(spark):
    rows = [(None, "no id at all here"), *((i, f"{TEXT} number {k} of {k * 7} others {i}") for k, i in enumerate(BIG)), (5, None), (6, "")]
    return ready(spark).createDataFrame(rows, "doc_id long, text string").coalesce(1)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(BIG[0], 1, 1), (BIG[1], 0, 0), (BIG[2], 1, 0), (BIG[3], 0, 1)], "doc_id long, quality int, toxic int")


def ids(df, col="doc_id"):
    return sorted((r[col] for r in df.collect()), key=str)


WANT = sorted([None, *BIG, 5, 6], key=str)


def test_ids_of_every_operator(spark, big, labels):
    lang = big.withColumn("lang", F.lit("en"))
    assert ids(lm.score(big, id_crc(F.col("doc_id")) % 7 != 2)) == WANT
    assert ids(licenses.scan(big)) == WANT
    assert ids(toxicity.classify(big, labels, lambda c: F.col(c).isNotNull(), "toxic")) == WANT
    assert ids(quality.classify(big, labels, F.col("doc_id").isNotNull(), "quality")) == WANT
    assert ids(language.predict(lang, language.fit(lang))) == WANT
    assert ids(neardup.join_counts(big)) == WANT
    assert ids(neardup.keep_one(big)) == WANT
    assert ids(sharding.place(big, sharding.document_key(big), ["a", "b"], 7)) == WANT


def test_ids_of_hits(spark, big):
    bench = spark.createDataFrame([("q-1", TEXT), (None, "no id at all here, but it is long enough")], "item_id string, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(big, bench).collect()}
    assert got == {(i, "q-1") for i in BIG}
    none = decontaminate.find(big, bench.where("item_id is null").withColumn("text", F.lit(TEXT)))
    assert {(r["doc_id"], r["item_id"]) for r in none.collect()} == {(i, None) for i in BIG}
    assert ids(decontaminate.clean(big, bench.where("item_id is null").withColumn("text", F.lit(TEXT)))) == sorted([None, 5, 6], key=str)


def test_keep_one_of_near_copies_with_large_ids(spark):
    base = " ".join(f"w{k}" for k in range(100))
    rows = [(None, base), (2 ** 60 + 1, base + " x"), (2 ** 60 + 3, base), (2 ** 60 + 5, "another text of a few words")]
    df = ready(spark).createDataFrame([(*r, "clash", "c") for r in rows], "doc_id long, text string, __key string, key string").coalesce(1)
    out = neardup.keep_one(df)
    assert out.columns == df.columns
    assert ids(out) == [2 ** 60 + 1, 2 ** 60 + 5]


@pytest.mark.parametrize("texts", [["you total idiot", "a nice day"], ["red one", "blue two", "a nice day"], ["", "a nice day"], ["bad", ""]])
def test_toxicity_with_very_few_labels(spark, texts):
    df = ready(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    y = spark.createDataFrame([(k, int(t != "a nice day" and k < len(texts) - 1)) for k, t in enumerate(texts)], "doc_id long, toxic int")
    got = toxicity.classify(df, y, lambda c: F.lit(True), "toxic").collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got)


def test_column_names_that_differ_only_in_case(spark):
    df = ready(spark).createDataFrame([(1, "a", "x")], "doc_id long, text string, Slot string")
    out = sharding.place(df, sharding.document_key(df), ["a", "b"], 7)
    assert [c.lower() for c in out.columns].count("slot") == 1 and out.count() == 1
