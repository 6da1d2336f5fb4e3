"""Tables and row keys shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsanalytics.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later steps
    start from a stored table, so a lost executor never repeats the work before it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str = "text") -> Column:
    """Text with null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """(row, text): all columns of the caller in one struct (the text only if it is to be kept), so that no
    name of theirs meets a working name."""
    kept = [column(c) for c in docs.columns if keep_text or c != text_col]
    return docs.select(F.struct(*kept or [F.lit(None).alias("none")]).alias("row"), column(text_col).alias("text"))


def with_row(src: DataFrame, fields: str) -> T.StructType:
    """Schema of ``row`` as in ``src`` and further fields."""
    return T.StructType([src.schema["row"], *T.StructType.fromDDL(fields).fields])


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A 64-bit key that, together with the id, names a row by content: rows that
    repeat both id and text share the key, and so share every result."""
    return F.xxhash64(F.col(id_col), text_of(text_col), F.lit("row"))


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return (crc % modulus) == remainder
