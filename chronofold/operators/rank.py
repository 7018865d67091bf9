"""Places of rows within large partitions, without a task that sorts all of one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUTS = 64


def place_in_partition(rows: DataFrame, partition: str, sort: str, tie: str, cuts: int = CUTS, descending: bool = False) -> DataFrame:
    """Adds `place`: the 1-based number of each row within its partition value, by `sort` (a number or time) and then `tie`.

    Approximate quantiles cut each partition value into ranges; a row's place is
    its number within its range plus the rows of the ranges before. The ranges
    come from explicit cut points, so places are exact however good these are.
    Rows of one partition and sort value are sorted by one task.
    """
    as_number = F.unix_micros(F.col(sort).cast("timestamp")) if rows.schema[sort].dataType.typeName().startswith("timestamp") else F.col(sort)
    keyed = rows.withColumn("__sort", as_number)
    share = [k / cuts for k in range(1, cuts)]
    edges = keyed.groupBy(partition).agg(F.percentile_approx("__sort", share, 1000).alias("__edges"))
    part = _bucket(F.col("__edges"), F.col("__sort"))
    ranged = keyed.join(edges, keyed[partition].eqNullSafe(edges[partition])).drop(edges[partition]).withColumn("__range", (-part if descending else part)).drop("__edges")
    sizes = ranged.groupBy(partition, "__range").agg(F.count(F.lit(1)).alias("__n"))  # `cuts` rows a partition value at most
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(partition).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col(partition).alias("__partition"), F.col("__range").alias("__number"), before.alias("__before"))
    order = [F.desc("__sort"), F.desc(tie)] if descending else [F.col("__sort"), F.col(tie)]
    own = F.row_number().over(Window.partitionBy(partition, "__range").orderBy(*order))
    placed = ranged.withColumn("__own", own).join(sizes, F.col(partition).eqNullSafe(F.col("__partition")) & (F.col("__range") == F.col("__number")))
    return placed.select(*[F.col(c) for c in rows.columns], (F.col("__own") + F.col("__before")).cast("bigint").alias("place"))


def _bucket(edges: Column, value: Column) -> Column:
    """How many cut points lie below the value."""
    return F.size(F.filter(edges, lambda e: e < value))
