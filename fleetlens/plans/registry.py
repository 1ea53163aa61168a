"""Query registry: name -> (job, oracle SQL).

Every job takes ``(spark, sf_dir)`` and returns a DataFrame over the driver
tables in ``sf_dir``.  The oracle is ANSI SQL that DuckDB runs over the same
Parquet files (views named after the tables); the column names match.
"""

from __future__ import annotations

import datetime as dt
import importlib
import sys
import threading
from collections import OrderedDict
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

from fleetlens.session import ensure_session

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` (with its DuckDB oracle when SQL-expressible)."""
    def deco(fn: Job) -> Job:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session(spark)
            return fn(spark, sf_dir.rstrip("/"))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.__module__ = fn.__module__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


PLAN_MODULES = ("tables", "registry", "rollups", "primitives", "dataflow", "reports", "reports_devices", "reports_uptime",
                "reports_companies", "reports_shapes", "endpoints", "costs", "coverage",
                "funnels", "kinds", "modules", "causes")
_LOCK = threading.Lock()
#: Sets of plan modules by evaluation date; the least recently asked for go first.
_AT: OrderedDict[dt.date, dict[str, ModuleType]] = OrderedDict()
MOST_DATES = 16


def modules(as_of: dt.date) -> dict[str, ModuleType]:
    """The plan modules as of an evaluation date, by their short names.

    All windows, cut-offs and oracle texts of the plan modules follow from
    ``tables.AS_OF``.  A set for another date is a second instance of these
    modules made with that date; the default set is left alone.
    """
    from fleetlens import plans
    from fleetlens.plans import tables
    load_all()
    if as_of == tables.AS_OF:
        return {m: importlib.import_module(f"fleetlens.plans.{m}") for m in PLAN_MODULES}
    with _LOCK:
        if as_of not in _AT:
            names = [f"{plans.__name__}.{m}" for m in PLAN_MODULES]
            kept = {n: sys.modules.pop(n) for n in names if n in sys.modules}
            try:
                fresh = importlib.import_module(names[0])
                fresh.set_as_of(as_of)
                importlib.import_module(names[1]).load_all()
                _AT[as_of] = {m: sys.modules[n] for m, n in zip(PLAN_MODULES, names)}
            finally:
                for n in names:
                    sys.modules.pop(n, None)
                sys.modules.update(kept)
                for n, m in kept.items():
                    setattr(plans, n.rpartition(".")[2], m)
            while len(_AT) > MOST_DATES:
                _AT.popitem(last=False)
        _AT.move_to_end(as_of)
        return _AT[as_of]


def jobs(as_of: dt.date) -> tuple[dict[str, Job], dict[str, str]]:
    """(queries, oracles) of every job as of an evaluation date."""
    own = modules(as_of)["registry"]
    return own.QUERIES, own.ORACLE


def load_all() -> None:
    """Import every plan module so their queries register."""
    for m in PLAN_MODULES:
        importlib.import_module(f"fleetlens.plans.{m}")
