"""File and table sources/sinks.

Reads are declarative (``spark.read`` with an explicit schema), so column
pruning and filter pushdown reach the scan; writes use Spark writers, which
are atomic per job and safe to retry after a lost executor.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException, PySparkException

from opsanalytics.functions.scalar import NULL_TOKENS

O2C_TABLES = ("loading_events", "dispatch_events", "invoices", "payments")
ORDER_COL = "_row"


class SourceMissingError(FileNotFoundError):
    """A required export is missing (with a hint of what to run)."""


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str], tokens: Sequence[str] = NULL_TOKENS,
                 order_col: str | None = ORDER_COL) -> DataFrame:
    """CSV with every column read as string; null tokens become NULL.

    ``order_col`` is the row's place in the input, as a struct that sorts by file
    path, then by the split's start in the file, then by row within the split, so
    "keep first" follows the files whatever order they are read in.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    values = [F.when(~F.col(c).isin(list(tokens)), F.col(c)).alias(c) for c in columns]
    if order_col:
        # Rows of one split stay in order inside one task, so the id orders them.
        values.append(F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                               F.monotonically_increasing_id().alias("row")).alias(order_col))
    return df.select(*values)


def read_bundle(spark: SparkSession, paths: Mapping[str, str], columns: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """The four exports as a dict; a missing file raises with a hint."""
    out = {}
    for name, path in paths.items():
        try:
            df = read_raw_csv(spark, path, columns[name])
            df.schema  # noqa: B018 - resolves the path now
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
                raise SourceMissingError(f"{name}: {path} not found; generate or land the export first") from exc
            raise
        out[name] = df
    return out


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str, timestamp_format: str | None = None) -> DataFrame:
    """S3: CSV with declared types (dates parsed by pattern)."""
    r = spark.read.schema(schema).option("header", True)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    return r.csv(path)


def read_dayfirst_csv(spark: SparkSession, path: str, columns: Sequence[str], date_cols: Sequence[str]) -> DataFrame:
    """Day-first dates (``31/12/2026``) parsed after an all-string read."""
    from opsanalytics.functions.scalar import parse_dayfirst_date

    df = read_raw_csv(spark, path, columns, order_col=None)
    return df.withColumns({c: parse_dayfirst_date(c) for c in date_cols})


def sql_scan(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """SQL text over DataFrames bound as named parameters (``{name}`` in the text)."""
    return spark.sql(text, **views)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The catalog's tables as a DataFrame (name, database, temporary)."""
    rows = [(t.name, t.database, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, database string, is_temporary boolean")


def read_or_else(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame],
                 probe: bool = False) -> tuple[DataFrame, str]:
    """The primary source, or a substitute when it is not there or cannot be read.

    Returns the table and which source was used; why the primary was not goes to the log.  Only Spark's own
    read errors and missing files count; other errors are raised.  ``probe`` reads one row, for sources that fail only then.
    If the primary resolves but its probe fails, the substitute must have the same schema."""
    resolved = None
    try:
        resolved = primary()
        resolved.schema  # noqa: B018 - resolves the path now
        if probe:
            resolved.limit(1).collect()
        return resolved, "primary"
    except (PySparkException, FileNotFoundError) as exc:
        df = fallback()
        if resolved is not None and probe:
            assert_same_schema(resolved, df)
        logging.getLogger(__name__).warning("fallback source used: %s: %s", type(exc).__name__, exc)
        return df, "fallback"


def assert_same_schema(a: DataFrame, b: DataFrame) -> None:
    if [(f.name, f.dataType) for f in a.schema] != [(f.name, f.dataType) for f in b.schema]:
        raise ValueError("fallback schema differs from the primary source")


def load_replace(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> int:
    """Idempotent load (overwrite) and the loaded row count read back from storage."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return df.sparkSession.read.format(fmt).load(path).count()


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV sink with a header.  ``single_file`` only for small reports."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_json_document(doc: DataFrame, path: str) -> None:
    """A one-row summary written as one JSON document."""
    doc.select(F.to_json(F.struct(*doc.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S13 read-back: a missing document is an error."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as exc:
        raise SourceMissingError(f"summary not found at {path}; run the job first") from exc


RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("raw_rows", T.LongType()),
        T.StructField("clean_rows", T.LongType()),
        T.StructField("raw_rows_by_table", T.MapType(T.StringType(), T.LongType())),
        T.StructField("clean_rows_by_table", T.MapType(T.StringType(), T.LongType())),
        T.StructField("gate_status", T.StringType()),
        T.StructField("total_leakage_kes", T.DoubleType()),
        T.StructField("exception_count", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


def append_run_log(spark: SparkSession, path: str, record: Mapping[str, object]) -> None:
    """One row appended to the run table (called in ``finally``)."""
    row = [tuple(record.get(f.name) for f in RUN_LOG_SCHEMA.fields)]  # extra keys (e.g. phase timings) stay in the record
    spark.createDataFrame(row, RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """S14 read-back: a missing log is an empty table."""
    try:
        return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], RUN_LOG_SCHEMA)


ISSUE_LOG_SCHEMA = "table string, check string, severity string, count bigint, detail string"


def read_issue_log(spark: SparkSession, path: str) -> DataFrame:
    """A missing log is an empty frame; a missing detail is ''."""
    try:
        df = spark.read.schema(ISSUE_LOG_SCHEMA).option("header", True).csv(path)
    except AnalysisException:
        df = spark.createDataFrame([], ISSUE_LOG_SCHEMA)
    return df.na.fill({"detail": ""})
