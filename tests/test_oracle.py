"""Every registered job against its DuckDB oracle on the driver tables (sf0.01)."""

import pytest

from fleetlens.plans.check import compare
from fleetlens.plans.registry import ORACLE, QUERIES, load_all

load_all()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_job_matches_oracle(spark, duck, sf_dir, name):
    r = compare(spark, duck, name, QUERIES[name], ORACLE.get(name), sf_dir)
    assert r["ok"] is not False, r


def test_every_job_has_an_oracle_or_is_listed():
    missing = sorted(n for n, job in QUERIES.items() if n not in ORACLE and job.__module__.startswith("fleetlens.plans."))
    # jobs without SQL oracle are checked against brute force in test_operators.py
    assert set(missing) <= {"S03b_read_matching_frames"}, missing


_SPARK_TYPES = {"bigint": "int64", "int": "int32", "double": "float64", "string": "str", "boolean": "bool",
                "date": "date", "timestamp_ntz": "ts"}
_DUCK_TYPES = {"BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "float64", "VARCHAR": "str", "BOOLEAN": "bool",
               "DATE": "date", "TIMESTAMP": "ts"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_job_types_match_oracle(spark, duck, sf_dir, name):
    spark_types = {f.name: _SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in QUERIES[name](spark, sf_dir).schema.fields}
    rel = duck.sql(ORACLE[name])
    duck_types = {c: _DUCK_TYPES.get(str(t).upper(), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
