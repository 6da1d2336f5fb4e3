"""Ranks and running sums in a total order, without a task per group.

``row_number`` and running windows put a whole group into one task.  Here the rows are
range-partitioned by (group, order) first, so a group of any size spans as many
partitions as its share of the rows, however its order values are spread:

1. range partitions by (group, order, hash of the row), stored so that a partition keeps
   its number and its rows;
2. counts and sums per (group, partition): a few rows per group, whose running totals are
   the offsets at which the partitions start;
3. row numbers and running sums inside (group, partition), plus the offsets.

Rows that agree in every column are interchangeable and stay together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsanalytics.session import cut_lineage


def _ascending(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def with_ranks(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (), sums: Mapping[str, str] | None = None,
               rank: str = "_rn") -> DataFrame:
    """Adds ``rank`` (1, 2, ... per group) and, for each ``sums`` entry name -> column, the sum over all earlier rows."""
    by, order, sums = list(by), _ascending(order), dict(sums or {})
    last = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    groups = [F.col(f"`{c}`") for c in by]
    placed = cut_lineage(df.repartitionByRange(*groups, *order, last).withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy(*by, "_part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_sum_{k}") for k, c in sums.items()])
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offset = {"_off": F.coalesce(F.sum("_n").over(before), F.lit(0))}
    offset |= {f"_off_{k}": F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)) for k in sums}
    keys = [F.col(f"`{c}`").alias(f"_key_{i}") for i, c in enumerate(by)]
    starts = cut_lineage(totals.withColumns(offset).select(*keys, F.col("_part").alias("_start"), *offset))
    on = [F.col(f"`{c}`").eqNullSafe(F.col(f"_key_{i}")) for i, c in enumerate(by)] + [F.col("_part") == F.col("_start")]
    here = Window.partitionBy(*by, "_part").orderBy(*order, last)
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.join(starts, on).withColumns(
        {rank: F.col("_off") + F.row_number().over(here)}
        | {k: F.col(f"_off_{k}") + F.coalesce(F.sum(c).over(earlier), F.lit(0)) for k, c in sums.items()})
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], rank, *sums)
