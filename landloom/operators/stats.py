"""Counts and summaries of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNITS = ("B", "KB", "MB", "GB", "TB")  # fixed values


def records_per_group(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias("records"))


def summary(counts: DataFrame, group: str, value: str = "records") -> DataFrame:
    """One row: total, mean, largest and smallest with their groups (of ties, the first by name)."""
    top = F.min_by(group, F.struct(-F.col(value), F.col(group)))
    low = F.min_by(group, F.struct(value, group))
    return counts.agg(
        F.count("*").alias("groups"),
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.max(value).alias("largest"),
        top.alias("largest_group"),
        F.min(value).alias("smallest"),
        low.alias("smallest_group"),
    )


def distinct_per_group(df: DataFrame, group: str, value: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(value) if approximate else F.countDistinct(value)
    return df.groupBy(group).agg(count.alias("distinct_values"))


#: log2 of the registers of a sketch: a relative error of about 0.8 per cent.
REGISTERS = 14


def distinct_sketches(df: DataFrame, by: list[str], value: str, registers: int = REGISTERS) -> DataFrame:
    """(*by, sketch): mergeable counts of distinct values, to be stored for groups as fine as will be asked for. Nulls
    count for nothing."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(value).cast("string"), registers).alias("sketch"))


def distinct_from(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(*by, distinct_values): estimates for any roll-up of stored sketches, without the rows they were made of."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))


def top(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(k)


def readable_size(size):
    """Bytes in the largest unit in which they are 1 or more, to two decimals."""
    c = F.col(size) if isinstance(size, str) else size
    out = F.concat(F.format_number(c.cast("double"), 2), F.lit(" B"))
    for k, unit in enumerate(UNITS[1:], 1):
        out = F.when(c >= 1024**k, F.concat(F.format_number(c / 1024**k, 2), F.lit(f" {unit}"))).otherwise(out)
    return out


def archive_volume(members: DataFrame) -> DataFrame:
    """Per archive: members and bytes, also readable; members(archive, member, size)."""
    by = members.groupBy("archive").agg(F.count("*").alias("members"), F.sum("size").alias("bytes"))
    return by.withColumn("volume", readable_size("bytes"))
