"""CSV and JSON ingest into typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from lograft.functions.frames import with_computed

# Fixed value: the routine-load table's columns (user_id, name, age).
ROUTINE_LOAD_DDL = "user_id BIGINT, name STRING, age INT"
# Fixed value: the CSV file table of the SQL job.
CSV_TABLE_DDL = "a STRING, b INT, c INT, d INT, e DECIMAL(20,6)"


def _judged(df: DataFrame, names: list[str], bad: str) -> DataFrame:
    """``bad="drop"``: well-formed rows only; ``"flag"``: all rows with ``reject_reason`` and their ``line``."""
    if bad == "flag":
        return df.select(*names, "reject_reason", "line")
    return df.where(F.col("reject_reason").isNull()).select(*names)


def parse_csv_lines(df: DataFrame, schema_ddl: str = ROUTINE_LOAD_DDL,
                    value_col: str = "value", sep: str = ",", bad: str = "drop") -> DataFrame:
    """``COLUMNS TERMINATED BY sep`` + ``COLUMNS(...)`` over text values.

    A line with another number of columns or a value that its column cannot hold
    is malformed and never enters the table (see ``_judged``).
    """
    names = [f.name for f in _parse_datatype_string(schema_ddl).fields]
    parsed = F.from_csv(F.col(value_col), f"{schema_ddl}, _corrupt STRING",
                        {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = df.select(F.col(value_col).alias("line"), parsed.alias("_r")).select("line", "_r.*")
    reason = F.when(F.col("_corrupt").isNotNull(), F.lit("malformed"))
    return _judged(rows.withColumn("reject_reason", reason), names, bad)


def parse_json_lines(df: DataFrame, jsonpaths: dict[str, tuple[str, str]],
                     value_col: str = "value", bad: str = "drop") -> DataFrame:
    """S3: jsonpath -> column mapping with renaming and casts.

    ``jsonpaths`` maps target column -> (``$.path``, type).  Top-level paths
    are read with one ``from_json`` pass; as soon as one path is deeper (``$.a.b``,
    ``$.a[0].b``) all are read from one VARIANT, so a line is parsed once
    whatever the number and depth of its paths.  A VARIANT holds numbers as
    numbers (``1.10`` is read as ``1.1``) and refuses documents that repeat a key.
    A missing path gives null.  A line that is no JSON object, or a value
    that its column cannot hold, never stops the load (see ``_judged``).
    """
    top = {t: p[2:] for t, (p, _) in jsonpaths.items()
           if p.startswith("$.") and "." not in p[2:] and "[" not in p[2:]}
    if len(top) < len(jsonpaths):
        staged = with_computed(df.select(F.col(value_col).alias("line")), {"_j": F.try_parse_json("line")})
        # an array of values is well-formed JSON, but no document
        is_object = F.substring(F.ltrim("line", F.lit(" \t\r\n")), 1, 1) == "{"
        malformed = F.col("_j").isNull() | ~is_object
        source = {t: F.try_variant_get("_j", p, "string") for t, (p, _) in jsonpaths.items()}
    else:
        schema = ", ".join([*(f"`{s}` STRING" for s in sorted(set(top.values()))), "_corrupt STRING"])
        staged = df.select(F.col(value_col).alias("line"), F.from_json(
            F.col(value_col), schema, {"columnNameOfCorruptRecord": "_corrupt"}).alias("_j"))
        malformed = F.col("_j._corrupt").isNotNull()
        source = {t: F.col("_j").getField(top[t]) for t in jsonpaths}
    reasons = [F.when(malformed | F.col("line").isNull(), F.lit("malformed"))]
    reasons += [F.when(source[t].isNotNull() & source[t].try_cast(ty).isNull(), F.lit(f"bad:{t}"))
                for t, (_, ty) in jsonpaths.items()]
    rows = staged.select("line", F.coalesce(*reasons).alias("reject_reason"),
                         *[source[t].try_cast(ty).alias(t) for t, (_, ty) in jsonpaths.items()])
    return _judged(rows, list(jsonpaths), bad)


def read_csv_table(spark: SparkSession, path: str, schema_ddl: str = CSV_TABLE_DDL,
                   sep: str = ",", view: str | None = "test_table",
                   validate_all_columns: bool = False) -> DataFrame:
    """Header-less CSV with a declared schema, optionally as a temp view.

    With column pruning a bad value in an unselected column goes unnoticed
    under FAILFAST; ``validate_all_columns`` adds a corrupt-record column so
    whole rows are checked.
    """
    reader = spark.read.schema(schema_ddl).option("sep", sep).option("header", "false")
    if validate_all_columns:
        reader = spark.read.schema(schema_ddl + ", _corrupt STRING").option("sep", sep) \
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    else:
        reader = reader.option("mode", "FAILFAST")
    df = reader.csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def render_csv_lines(df: DataFrame, cols: list[str], sep: str = ",") -> DataFrame:
    """Rows -> ``value`` text lines (test feed for S2)."""
    return df.select(F.to_csv(F.struct(*cols), {"sep": sep}).alias("value"))


def render_json_lines(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows -> ``value`` JSON lines (test feed for S3)."""
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def read_csv_stream(spark: SparkSession, path: str, schema_ddl: str = CSV_TABLE_DDL,
                    sep: str = ",", max_files_per_trigger: int | None = None) -> DataFrame:
    """S5 as a stream: new CSV files in ``path`` become micro-batches."""
    r = spark.readStream.schema(schema_ddl).option("sep", sep).option("header", "false")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)
