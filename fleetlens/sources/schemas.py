"""Declared schemas of the event-table families, and conforming reads.

Schemas drift in practice (queries read columns some listings lack), so reads
go through :func:`conform`: select the declared columns in order, cast to the
declared type, null-fill absent nullable columns, and fail fast when a
required column is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, TS, B, L = T.StringType(), T.TimestampNTZType(), T.BooleanType(), T.LongType()


def _schema(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


# Column lists of the event families (name, type, nullable).
EVENT_SCHEMAS: dict[str, T.StructType] = {
    "installer_events": _schema(("event", S, False), ("event_details", S, True), ("display_id", S, True),
                                ("ip", S, True), ("os", S, True), ("installer_version", S, True), ("ts", TS, False)),
    "native_events": _schema(("event", S, False), ("event_details", S, True), ("display_id", S, True),
                             ("ip", S, True), ("os", S, True), ("chrome_version", S, True),
                             ("player_version", S, True), ("ts", TS, False)),
    "viewer_events": _schema(("event", S, False), ("event_details", S, True), ("display_id", S, True),
                             ("viewer_version", S, True), ("ts", TS, False)),
    "cache_events_v2": _schema(("event", S, False), ("event_details", S, True), ("error_details", S, True),
                               ("display_id", S, True), ("os", S, True), ("cache_version", S, True),
                               ("file_name", S, True), ("file_url", S, True), ("ts", S, False)),
    "second_os_player_events": _schema(("event", S, False), ("event_details", S, True), ("id", S, False),
                                       ("ip", S, True), ("os", S, True), ("chrome_version", S, True),
                                       ("player_version", S, True), ("ts", TS, False)),
    "uptime_events": _schema(("ts", TS, False), ("display_id", S, False), ("showing", B, True),
                             ("connected", B, True), ("scheduled", B, True)),
    "component_uptime_events": _schema(("ts", TS, False), ("display_id", S, False), ("presentation_id", S, False),
                                       ("template_product_code", S, False), ("template_version", S, False),
                                       ("component_type", S, False), ("component_id", S, False),
                                       ("responding", B, True), ("error", B, True)),
    "template_uptime_events": _schema(("ts", TS, False), ("display_id", S, False), ("presentation_id", S, False),
                                      ("template_product_code", S, False), ("template_version", S, False),
                                      ("responding", B, True), ("error", B, True)),
    "component_events": _schema(("event", S, False), ("event_details", S, True), ("usage_type", S, True),
                                ("version", S, True), ("display_id", S, True), ("ts", TS, False)),
    "image_events": _schema(("event", S, False), ("event_details", S, True), ("error_details", S, True),
                            ("display_id", S, True), ("company_id", S, True), ("file_url", S, True),
                            ("file_format", S, True), ("version", S, True), ("ts", TS, False)),
    "video_events": _schema(("event", S, False), ("event_details", S, True), ("display_id", S, True),
                            ("company_id", S, True), ("file_url", S, True), ("file_format", S, True),
                            ("ts", TS, False)),
    "rss_events": _schema(("event", S, False), ("event_details", S, True), ("error_details", S, True),
                          ("feed_url", S, True), ("display_id", S, True), ("company_id", S, True), ("ts", S, False)),
    "spreadsheet_events": _schema(("event", S, False), ("event_details", S, True), ("error_details", S, True),
                                  ("url", S, True), ("api_key", S, True), ("request_url", S, True),
                                  ("display_id", S, True), ("company_id", S, True), ("ts", TS, False)),
    "template_events": _schema(("event", S, False), ("display_id", S, True), ("template_id", S, False),
                               ("template_name", S, True), ("ts", TS, False)),
}


class SchemaError(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType | str, *, strict: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``: declared order, declared types, nulls for absent columns.

    Casts use ``try_cast`` semantics so a malformed value becomes NULL instead of
    failing the job (legacy casts behave that way).  A *required* column that is
    absent raises.  Rows whose required columns hold a NULL stay (``violations`` has
    them); with ``strict`` they are left out.
    """
    if isinstance(schema, str):
        schema = EVENT_SCHEMAS[schema]
    have = set(df.columns)
    out, required = [], []
    for f in schema.fields:
        if f.name in have:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
            if not f.nullable:
                required.append(f.name)
        elif f.nullable:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise SchemaError(f"required column {f.name!r} missing")
    res = df.select(*out)
    if strict and required:
        cond = None
        for c in required:
            cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
        res = res.where(cond)
    return res


def violations(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Rows of the conformed ``df`` that hold a NULL in a required column, with the columns' names in ``missing``."""
    schema = EVENT_SCHEMAS[schema] if isinstance(schema, str) else schema
    required = [f.name for f in schema.fields if not f.nullable]
    names = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]).cast("array<string>")
    return conform(df, schema).withColumn("missing", F.filter(names, lambda x: x.isNotNull())).where(F.size("missing") > 0)


def create_event_table(spark: SparkSession, name: str, family: str, location: str,
                       partition_col: str = "event_date") -> None:
    """``CREATE TABLE ... USING parquet PARTITIONED BY (event_date)`` for a family."""
    schema = EVENT_SCHEMAS[family]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
                     for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, `{partition_col}` date) USING parquet "
              f"PARTITIONED BY ({partition_col}) LOCATION '{location}'")
