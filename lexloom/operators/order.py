"""Places in an order that no single task has to sort."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def settled(df: DataFrame) -> DataFrame:
    """The rows written to the folder in ``spark.checkpoint.dir``: read twice, they are the same.

    Where the setting is unset, a folder of our own if driver and executors are one process; else an error."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        found = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not found and not re.fullmatch(r"local(\[[^-]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(found or f"file://{tempfile.mkdtemp(prefix='lexloom-')}")
    return df.checkpoint()


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranged(df: DataFrame, order: list[Column], name: str = "_range") -> DataFrame:
    """The rows with the number of their range in the order.  Ranges are of like size whatever the keys,
    so a day, prefix or name that holds most rows is spread over several."""
    return settled(df.repartitionByRange(tasks(df.sparkSession), *order).withColumn(name, F.spark_partition_id()))


def placed(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """The rows with their place, from 1, in their group.

    Rows are numbered inside each range; only the table of groups' counts in ranges (a row for each
    group and at most one more for each range) is added up and joined."""
    rows = ranged(df, [*map(F.col, group), *order])
    inside = F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    skip = rows.groupBy(*group, "_range").agg(F.count("*").alias("_rows")).withColumn("_skip", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    numbered = rows.withColumn("_inside", inside)
    same = [numbered[g].eqNullSafe(skip[g]) for g in [*group, "_range"]]
    return numbered.join(skip, same).select(*[numbered[c] for c in df.columns], (F.col("_skip") + F.col("_inside")).alias(name))
