"""The registered queries against their SQL, and their columns."""
import pytest

import __spark_entry__ as entry
from fleetlens.plans.check import compare

WITH_SQL = ["op1_sharding", "op9_topk", "op10_mixing", "op12_collocations", "op13_negatives"]
COLUMNS = {
    "op1_sharding": ["doc_id", "slot", "shard"],
    "op2_lm_score": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_quality": ["doc_id", "held_out", "score", "predicted"],
    "op8_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op9_topk": ["query_id", "rank", "vec_id", "score"],
    "op10_mixing": ["doc_id", "size", "source_size", "target", "taken", "first_slot"],
    "op11_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op12_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op13_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
}


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_agrees_with_its_sql(spark, duck, sf_dir, name):
    got = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], sf_dir)
    assert got["ok"], got


@pytest.mark.parametrize("name", [*COLUMNS, "op3_decontamination", "op4_licenses", "op7_neardup", "pipeline"])
def test_query_is_registered(name):
    assert name in entry.queries()


@pytest.mark.parametrize("name", ["op10_mixing", "op1_sharding"])
def test_native_plan_has_no_python(spark, sf_dir, name):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_contract_columns_of_small_queries(spark, sf_dir):
    for name in ("op1_sharding", "op8_language", "op10_mixing", "op11_packing", "op13_negatives"):
        df = entry.queries()[name](spark, sf_dir)
        assert df.columns[:len(COLUMNS[name])] == COLUMNS[name]
