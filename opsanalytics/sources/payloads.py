"""Semi-structured payloads as columns: JSON API bodies and HTML pages.

Payloads are string columns, so many documents are parsed in parallel; each
row is expanded with generators (``inline``, ``posexplode``), never collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parallel_arrays_schema(time_key: str, fields: Sequence[str], container: str = "hourly") -> T.StructType:
    arrays = [T.StructField(time_key, T.ArrayType(T.StringType()))] + [
        T.StructField(f, T.ArrayType(T.DoubleType())) for f in fields
    ]
    return T.StructType([T.StructField(container, T.StructType(arrays))])


def explode_parallel_arrays(df: DataFrame, payload: str, time_key: str, fields: Sequence[str], container: str = "hourly",
                            keep: Sequence[str] = ()) -> DataFrame:
    """``{container: {time: [...], a: [...], b: [...]}}`` -> one row per position."""
    parsed = df.select(*keep, F.from_json(F.col(payload), parallel_arrays_schema(time_key, fields, container)).alias("_p"))
    zipped = F.arrays_zip(*[F.col(f"_p.{container}.{c}").alias(c) for c in [time_key, *fields]])
    return parsed.select(*keep, F.inline(zipped))


def explode_records(df: DataFrame, payload: str, record_schema: T.StructType | str, key: str = "records",
                    keep: Sequence[str] = ()) -> DataFrame:
    """``{records: [{...}, ...]}`` -> one row per record."""
    rs = record_schema if isinstance(record_schema, T.StructType) else T._parse_datatype_string(record_schema)  # noqa: SLF001
    schema = T.StructType([T.StructField(key, T.ArrayType(rs))])
    return df.select(*keep, F.from_json(F.col(payload), schema).alias("_p")).select(*keep, F.inline(f"_p.{key}"))


def _strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "<[^>]*>", ""))


def html_table_rows(df: DataFrame, html: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every ``<table>`` row as (table_no, row_no, cells[]); header rows use ``<th>``.

    Pure regex over the page column; tables, rows and cells are expanded with
    ``posexplode`` so the work is per page, in parallel.
    """
    tables = df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit("(?s)<table[^>]*>(.*?)</table>"), 1)).alias("table_no", "t"))
    rows = tables.select(*keep, "table_no", F.posexplode(F.regexp_extract_all("t", F.lit("(?s)<tr[^>]*>(.*?)</tr>"), 1)).alias("row_no", "r"))
    cells = F.transform(F.regexp_extract_all("r", F.lit("(?s)<t[hd][^>]*>(.*?)</t[hd]>"), 1), _strip_tags)
    return rows.select(*keep, "table_no", "row_no", F.col("r").contains("<th").alias("is_header"), cells.alias("cells"))


def html_table_records(df: DataFrame, html: str, keep: Sequence[str] = ()) -> DataFrame:
    """Body rows keyed by the table's header (from its ``<th>`` row) as a map."""
    rows = html_table_rows(df, html, keep)
    header = rows.filter("is_header").select(*keep, "table_no", F.col("cells").alias("header"))
    body = rows.filter(~F.col("is_header"))
    j = body.join(header, [*keep, "table_no"], "left")
    return j.select(*keep, "table_no", "row_no", F.map_from_arrays("header", "cells").alias("record"))


def html_list_links(df: DataFrame, html: str, keep: Sequence[str] = ()) -> DataFrame:
    """S7 on list markup: every ``<li><a href=..>text</a></li>`` as (pos, href, text)."""
    pat = '<li><a href="([^"]*)">([^<]*)</a></li>'
    x = df.select(*keep, F.regexp_extract_all(F.col(html), F.lit(pat), 1).alias("_h"),
                  F.regexp_extract_all(F.col(html), F.lit(pat), 2).alias("_t"))
    return x.select(*keep, F.posexplode(F.arrays_zip(F.col("_h").alias("href"), F.col("_t").alias("text"))).alias("pos", "_z")).select(
        *keep, "pos", "_z.href", "_z.text")
