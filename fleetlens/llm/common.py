"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetlens.session import checkpoint_dir

#: One word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Labels whose counts are broadcast.
FEW_LABELS = 10_000
#: Rows of an Arrow batch: texts may be long, and a Python worker holds a batch twice.
BATCH_ROWS = 2000


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, and bound their Arrow batches.

    A cluster whose machines do not share that path installs the package or names it
    in --py-files; the entry is then unused.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Only a session without one that runs in a single JVM (tests, a laptop) gets a folder of its own.
    """
    if spark.conf.get("spark.checkpoint.dir", None):
        return checkpoint_dir(spark)
    master = spark.sparkContext.master
    if master.startswith("local[") or master == "local":
        return checkpoint_dir(spark, os.path.join(tempfile.gettempdir(), "fleetlens-checkpoints"))
    raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage there."""
    sc = df.sparkSession.sparkContext
    where = shared_folder(df.sparkSession)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(where)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_EXACT = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype(),
          pa.bool_(): pd.BooleanDtype()}


def tidy(run):
    """``run`` (a generator of result batches), which at its end returns freed memory to the system.

    Python workers serve many tasks; without this they keep the most that any needed.
    """
    def tidied(*batches):
        try:
            yield from run(*batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library
                ctypes.CDLL("libc.so.6").malloc_trim(0)
    return tidied


def map_pandas(df: DataFrame, run, schema: str | T.StructType) -> DataFrame:
    """``mapInPandas`` that leaves whole numbers and booleans beside NULLs as they are.

    Pandas turns a long column with a NULL into doubles, which changes large ids; here
    such columns are pandas' nullable kinds, and results go back through Arrow.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = to_arrow_schema(schema)

    def arrow(batches):
        for x in run(b.to_pandas(types_mapper=_EXACT.get) for b in batches):
            yield pa.RecordBatch.from_arrays([pa.array(x[f.name], f.type, from_pandas=True) for f in kinds], schema=kinds)
    return df.mapInArrow(tidy(arrow), schema)


def keep_rows(docs: DataFrame, text: str, make) -> DataFrame:
    """Rows of ``docs`` whose text passes; ``make()`` gives a task its function from texts (or None) to booleans.

    All columns stay as they are (Arrow batches are filtered, never converted); no shuffle.
    """
    def run(batches):
        test = make()
        for b in batches:
            yield b.filter(pa.array([bool(x) for x in test(b.column(text).to_pylist())], pa.bool_()))
    return docs.mapInArrow(tidy(run), docs.schema)


def n_words(text: Column) -> Column:
    """Number of words of a text (NULL: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_crc(doc_id: Column) -> Column:
    """CRC-32 of the id as text (a NULL id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def digest60(key: Column) -> Column:
    """First 60 bits of MD5 as a non-negative long; the same number in any SQL engine."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def first_by_hash(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label: a bounded sample that does not depend on the partitioning.

    Rows are thinned by hashed key to about twice the bound before any are ranked, so
    no task gets all rows of a frequent label.  ``rows`` should hold no long columns.
    """
    n = cut(rows.groupBy(label).agg(F.count("*").alias("__n")).withColumnRenamed(label, "__label"))
    few = n.count() <= FEW_LABELS  # then no row is shuffled before it is thinned
    u = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    near = (rows.join(F.broadcast(n) if few else n, F.col(label) == F.col("__label")).withColumn("__u", u)
            .where(F.col("__u") * F.col("__n") < 2.0 * per_label + 50))
    first = Window.partitionBy(label).orderBy("__u", key)
    return (near.withColumn("__rank", F.row_number().over(first)).where(F.col("__rank") <= per_label)
            .select(*rows.columns))
