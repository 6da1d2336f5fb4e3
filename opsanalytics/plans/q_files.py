"""File sources, sinks and logs on the driver tables.

Every query lands a driver table in the shared checkpoint folder, reads it back with the
library and returns what came back, so the SQL twin works on the table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from opsanalytics.functions.nulls import exact_sum
from opsanalytics.operators import filters as fl
from opsanalytics.plans.driver_tables import read_table
from opsanalytics.plans.registry import finish, query
from opsanalytics.plans.sqlkit import sql_finish
from opsanalytics.session import checkpoint_dir
from opsanalytics.sources import files as io


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "s1_raw_csv_null_tokens",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS c_mktsegment, "
    "CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS place FROM customer",
)
def s1_raw_csv_null_tokens(spark, sf_dir):
    token = F.element_at(F.array(*[F.lit(t) for t in ("NA", "null", "-NaN", "N/A")]), (F.col("c_custkey") % 3 + 1).cast("int"))
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).otherwise(token).alias("c_mktsegment"))
    path = _folder(spark, "s1")
    # Files hold ascending key ranges, so file order is key order.
    c.repartitionByRange(4, "c_custkey").sortWithinPartitions("c_custkey").write.option("header", True).csv(path)
    raw = io.read_raw_csv(spark, path, ["c_custkey", "c_mktsegment"])
    # The place in the files, per file range and then over the whole: never one window over all rows.
    files = raw.groupBy(F.col("_row.file").alias("file"), F.col("_row.start").alias("start")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.expr("sum(n) over (order by file, start rows between unbounded preceding and 1 preceding)"), F.lit(0))
    at = F.expr("row_number() over (partition by _row.file, _row.start order by _row)")
    x = raw.withColumn("at", at).join(files.withColumn("before", before),
                                      (F.col("_row.file") == F.col("file")) & (F.col("_row.start") == F.col("start")))
    return x.select("c_custkey", "c_mktsegment", (F.col("before") + F.col("at")).cast("bigint").alias("place"))


@query(
    "s2_bundle_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", CAST(count(*) AS BIGINT) AS n FROM {t}" for t in ("customer", "nation", "region", "supplier")),
)
def s2_bundle_row_counts(spark, sf_dir):
    base, columns = _folder(spark, "s2"), {}
    for t in ("customer", "nation", "region", "supplier"):
        df = read_table(spark, sf_dir, t)
        columns[t] = df.columns
        df.write.option("header", True).csv(f"{base}/{t}")
    bundle = io.read_bundle(spark, {t: f"{base}/{t}" for t in columns}, columns)
    out = None
    for t, df in bundle.items():
        row = df.agg(F.lit(t).alias("table"), F.count("*").cast("bigint").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "s3_typed_csv",
    sql_finish("SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, min(o_orderdate) AS first_date, max(o_totalprice) AS top_price FROM orders GROUP BY 1",
               doubles=["top_price"], times=["first_date"]),
)
def s3_typed_csv(spark, sf_dir):
    path = _folder(spark, "s3")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_orderpriority")
    o.write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    back = io.read_typed_csv(spark, path, o.schema, "yyyy-MM-dd HH:mm:ss")
    return finish(back.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first_date"), F.max("o_totalprice").alias("top_price")))


@query(
    "s9_catalog_listing",
    " UNION ALL ".join(f"SELECT 's9_{t}' AS name, true AS is_temporary, CAST(count(*) AS BIGINT) AS n FROM {t}" for t in ("nation", "orders", "part")),
)
def s9_catalog_listing(spark, sf_dir):
    for t in ("nation", "orders", "part"):
        read_table(spark, sf_dir, t).createOrReplaceTempView(f"s9_{t}")
    listed = io.list_tables(spark).filter(F.col("name").startswith("s9_"))
    counts = None
    for t in ("nation", "orders", "part"):
        row = io.sql_scan(spark, f"SELECT 's9_{t}' AS name, count(*) AS n FROM s9_{t}")
        counts = row if counts is None else counts.unionByName(row)
    return listed.join(counts, "name").select("name", "is_temporary", "n")


@query("s10_fallback_source", "SELECT 'fallback' AS used, CAST(count(*) AS BIGINT) AS n FROM supplier")
def s10_fallback_source(spark, sf_dir):
    df, used = io.read_or_else(lambda: spark.read.parquet(_folder(spark, "s10-missing")), lambda: read_table(spark, sf_dir, "supplier"))
    return df.agg(F.lit(used).alias("used"), F.count("*").cast("bigint").alias("n"))


@query(
    "s11_load_replace",
    sql_finish("SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1", doubles=["quantity"], digits=2),
)
def s11_load_replace(spark, sf_dir):
    li, path = read_table(spark, sf_dir, "lineitem"), _folder(spark, "s11")
    first = io.load_replace(li, path, partition_by=["l_returnflag"])
    if io.load_replace(li, path, partition_by=["l_returnflag"]) != first:
        raise ValueError("a repeated load changed the table")
    return finish(spark.read.parquet(path).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")), digits=2)


@query(
    "s12_csv_sink",
    "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1",
)
def s12_csv_sink(spark, sf_dir):
    path = _folder(spark, "s12")
    io.write_csv(read_table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")), path, single_file=True)
    return io.read_typed_csv(spark, path, "o_orderstatus string, n bigint")


@query(
    "s13_json_document",
    sql_finish("SELECT CAST(count(*) AS BIGINT) AS n_orders, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_customers, max(o_totalprice) AS top FROM orders",
               doubles=["top"], digits=2),
)
def s13_json_document(spark, sf_dir):
    path = _folder(spark, "s13")
    doc = read_table(spark, sf_dir, "orders").agg(
        F.count("*").alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers"), F.max("o_totalprice").alias("top"))
    io.write_json_document(doc, path)
    return finish(io.read_json_document(spark, path, "n_orders bigint, n_customers bigint, top double"), digits=2)


@query(
    "s14_run_log",
    sql_finish("SELECT * FROM (SELECT 'a' AS run_id, 'SUCCESS' AS status, count(*) + (SELECT count(*) FROM orders) AS raw_rows, "
               "count(*) AS raw_lineitem, (SELECT count(*) FROM orders) AS raw_orders, count(*) FILTER (l_quantity > 10) AS exception_count, "
               "max(l_quantity) AS total_leakage_kes, CAST(NULL AS VARCHAR) AS error FROM lineitem "
               "UNION ALL SELECT 'b', 'FAILED', count(*), NULL, count(*), NULL, NULL, repeat('x', 3000) FROM orders)",
               doubles=["total_leakage_kes"], bigints=["raw_rows", "raw_lineitem", "raw_orders", "exception_count"]),
)
def s14_run_log(spark, sf_dir):
    path = _folder(spark, "s14")
    li = read_table(spark, sf_dir, "lineitem").agg(
        F.count("*").alias("n"), F.max("l_quantity").alias("q"), F.count_if(F.col("l_quantity") > 10).alias("e")).first()
    n = read_table(spark, sf_dir, "orders").count()
    io.append_run_log(spark, path, {"run_id": "a", "status": "SUCCESS", "raw_rows": li["n"] + n, "raw_rows_by_table": {"lineitem": li["n"], "orders": n},
                                    "exception_count": li["e"], "total_leakage_kes": float(li["q"])})
    io.append_run_log(spark, path, {"run_id": "b", "status": "FAILED", "raw_rows": n, "raw_rows_by_table": {"orders": n}, "error": "x" * 3000})
    by = [F.col("raw_rows_by_table")[t].alias(f"raw_{t}") for t in ("lineitem", "orders")]
    return finish(io.read_run_log(spark, path).select("run_id", "status", "raw_rows", *by, "exception_count", "total_leakage_kes", "error"))


@query(
    "s15_issue_log",
    "SELECT o_orderstatus AS \"check\", CAST(count(*) AS BIGINT) AS \"count\", '' AS detail FROM orders GROUP BY 1",
)
def s15_issue_log(spark, sf_dir):
    path = _folder(spark, "s15")
    log = read_table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("check")).agg(F.count("*").alias("count"))
    log = log.select(F.lit("orders").alias("table"), "check", F.lit("warning").alias("severity"), "count", F.lit(None).cast("string").alias("detail"))
    io.write_csv(log, path)
    missing = io.read_issue_log(spark, _folder(spark, "s15-missing"))  # a log that is not there is empty
    return io.read_issue_log(spark, path).unionByName(missing).select("check", "count", "detail")


@query(
    "f3_require_rows",
    sql_finish("SELECT l_linestatus, CAST(count(*) AS BIGINT) AS n, 'Nothing left after filtering' AS empty_message, sum(l_quantity) AS quantity "
               "FROM lineitem GROUP BY 1", doubles=["quantity"], digits=2),
)
def f3_require_rows(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    try:
        fl.require_rows(li.filter(F.col("l_quantity") < 0))
        message = ""
    except fl.EmptyResultError as exc:
        message = str(exc)
    some = fl.require_rows(li)
    return finish(some.groupBy("l_linestatus").agg(F.count("*").alias("n"), F.lit(message).alias("empty_message"),
                                                   exact_sum("l_quantity").alias("quantity")), digits=2)
