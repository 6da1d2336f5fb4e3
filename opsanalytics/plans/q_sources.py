"""Payload sources on the driver tables.

JSON bodies are built from the data inside the query (one payload per event
type and day, as an API would return them) and parsed back with the library.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from opsanalytics.plans.driver_tables import read_table
from opsanalytics.plans.q_series import HOURLY_SQL, hourly
from opsanalytics.plans.registry import finish, query
from opsanalytics.plans.sqlkit import sql_finish
from opsanalytics.sources import payloads as pl


@query(
    "s5_parallel_arrays",
    sql_finish("SELECT event_type, strftime(bin, '%Y-%m-%dT%H:%M') AS time, mean_value, CAST(n AS DOUBLE) AS n FROM hourly",
               doubles=["mean_value", "n"], ctes=HOURLY_SQL),
)
def s5_parallel_arrays(spark, sf_dir):
    h = hourly(spark, sf_dir).withColumn("day", F.to_date("bin"))
    # One payload per (type, day): 24 positions, built with an ordered list.
    per_day = h.groupBy("event_type", "day").agg(F.array_sort(F.collect_list(F.struct("bin", "mean_value", "n"))).alias("v"))
    body = F.to_json(F.struct(F.struct(
        F.transform("v", lambda s: F.date_format(s["bin"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.transform("v", lambda s: s["mean_value"]).alias("mean_value"),
        F.transform("v", lambda s: s["n"].cast("double")).alias("n"),
    ).alias("hourly")))
    payloads = per_day.select("event_type", body.alias("payload"))
    return finish(pl.explode_parallel_arrays(payloads, "payload", "time", ["mean_value", "n"], keep=["event_type"]))


@query(
    "s6_records",
    sql_finish("SELECT event_type, CAST(count(*) AS BIGINT) AS n_records, sum(value) AS total_value, "
               "CAST(count(DISTINCT user_id) AS BIGINT) AS n_users FROM events GROUP BY event_type",
               doubles=["total_value"], digits=2),
)
def s6_records(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    # One payload per type, hour and user: no payload grows with a hot type.
    per = ev.groupBy("event_type", F.date_trunc("hour", "ts").alias("h"), F.col("user_id").alias("u")).agg(
        F.to_json(F.struct(F.collect_list(F.struct("user_id", "value")).alias("records"))).alias("payload"))
    recs = pl.explode_records(per, "payload", "user_id bigint, value double", keep=["event_type"])
    out = recs.groupBy("event_type").agg(F.count("*").alias("n_records"), F.sum("value").alias("total_value"),
                                         F.count_distinct("user_id").alias("n_users"))
    return finish(out, digits=2)


LINK_PATTERN = '<li><a href="([^"]*)">([^<]*)</a></li>'


@query(
    "s7_html_links",
    f"""
    WITH x AS (SELECT page_id, regexp_extract_all(html, '{LINK_PATTERN}', 1) AS h, regexp_extract_all(html, '{LINK_PATTERN}', 2) AS t FROM pages)
    SELECT page_id, CAST(unnest(range(len(h))) AS INT) AS pos, unnest(h) AS href, unnest(t) AS text FROM x
    """,
)
def s7_html_links(spark, sf_dir):
    return pl.html_list_links(read_table(spark, sf_dir, "pages"), "html", keep=["page_id"])


@query(
    "s7_html_tables",
    "SELECT n_name AS page, CAST(0 AS BIGINT) AS table_no, row_number() OVER (PARTITION BY n_name ORDER BY s_suppkey) AS row_no, "
    "CAST(s_suppkey AS VARCHAR) AS number, s_name AS name, CAST(CAST(round(s_acctbal * 100) AS BIGINT) AS VARCHAR) AS cents "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def s7_html_tables(spark, sf_dir):
    """Suppliers as one HTML table a nation; header and rows are read back from the page text."""
    rows = read_table(spark, sf_dir, "supplier").join(read_table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
    cells = [F.col("s_suppkey").cast("string"), F.col("s_name"), F.round(F.col("s_acctbal") * 100).cast("bigint").cast("string")]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td class='c'> "), c, F.lit("</td>")) for c in cells], F.lit("</tr>\n"))
    head = "<table border=1>\n<tr><th>number</th><th><b>name</b></th><th>cents</th></tr>\n"
    listed = F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", row.alias("r")))), lambda x: x["r"])
    pages = rows.groupBy(F.col("n_name").alias("page")).agg(F.concat(F.lit(head), F.array_join(listed, ""), F.lit("</table>")).alias("html"))
    recs = pl.html_table_records(pages, "html", keep=["page"])
    fields = [F.col("record")[c].alias(c) for c in ("number", "name", "cents")]
    return finish(recs.select("page", "table_no", "row_no", *fields))
