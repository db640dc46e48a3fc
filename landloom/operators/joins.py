"""Joins that repeat across jobs. Dimensions are broadcast by the planner where their size allows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landloom.functions import columns as C
from landloom.plans.schema import LOADED, enforce


def drop_withdrawn(df: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """Rows whose resource is not listed with status 410. Null resources stay; a null key in the list removes
    nothing."""
    gone = withdrawn.where(F.col("status") == "410").select(F.col("old_resource").alias("resource")).distinct()
    return df.join(gone, "resource", "left_anti")


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(~C.is_blank(column))


def active(df: DataFrame, end_date: str = "end_date") -> DataFrame:
    """Rows that have not ended."""
    return df.where(C.is_blank(end_date))


def backfill(df: DataFrame, lookup: DataFrame, on: str, column: str) -> DataFrame:
    """Fill blank values of column from lookup(on, column); a key with several values gives several rows, an unknown
    stays ''.

    One join: rows that have a value meet no lookup row."""
    own = lookup.select(F.col(on).alias("_key"), F.col(column).alias("_found")).distinct()
    blank = C.is_blank(column)
    joined = df.join(own, blank & (F.col(on) == F.col("_key")), "left")
    return joined.select(
        *[
            F.when(blank, F.coalesce("_found", F.lit(""))).otherwise(F.col(column)).alias(c)
            if c == column
            else c for c in df.columns
        ]
    )


def range_join(df: DataFrame, ranges: DataFrame, key: str, low: str, high: str) -> DataFrame:
    """Inner join on low <= key <= high, for numbers, as a join by equal keys, however wide the ranges are.

    A range of 2^(l-1) to 2^l numbers lies in one or two aligned blocks of 2^l, and is listed under these; a key is
    listed under its block at each level that some range has, 64 at most. So a range has two rows at most, and a block
    holds no keys that are farther from a range in it than four times its width. Neither side need fit into memory."""
    whole = lambda c: F.floor(F.col(c)).cast("bigint")
    sides = ranges.where(F.col(low) <= F.col(high)).withColumns({"_a": whole(low), "_b": whole(high)})
    span = F.try_subtract("_b", "_a")  # null where it is beyond the type
    level = F.when(span.isNull() | (span < 0), 63).when(span == 0, 0).otherwise(F.length(F.bin(span)))
    sides = sides.withColumn("_level", level.cast("int")).withColumn(
        "_block", F.explode(F.array_distinct(F.expr("array(shiftright(_a, _level), shiftright(_b, _level))")))
    )
    sides = sides.drop("_a", "_b")
    levels = sorted(r[0] for r in sides.select("_level").distinct().collect())
    at = F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright("_key", n).alias("block")) for n in levels])
    if not levels:
        at = F.array().cast("array<struct<level:int,block:bigint>>")
    keys = df.withColumn("_key", whole(key)).withColumn("_at", F.explode(at)).withColumns(
        {"_level": F.col("_at.level"), "_block": F.col("_at.block")}
    ).drop("_key", "_at")
    joined = keys.join(sides, ["_level", "_block"]).where(F.col(key).between(F.col(low), F.col(high)))
    return joined.drop("_level", "_block")


def range_stats(df: DataFrame, ranges: DataFrame, key: str, low: str, high: str, span: int = 1 << 62) -> DataFrame:
    """The ranges that hold keys, with n (rows whose key is in the range), first and total (least key, and their sum); for
    whole numbers, and keys less than span apart.

    What range_join() would list is counted without listing it: each distinct key is added up in its aligned block of
    2^l numbers at each level l, and a range, cut to the keys there are, is the sum of two blocks a level at most. So the
    work grows with keys and ranges, not with the pairs of them."""
    keys = df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("_key")).agg(F.count("*").alias("n"))
    least, most = df.agg(F.min(key).cast("bigint"), F.max(key).cast("bigint")).first()
    own = ranges.where(F.col(low) <= F.col(high)).groupBy(*ranges.columns).agg(F.count("*").alias("_times"))  # ranges that are alike are counted once
    if least is None:
        least = most = 0
    if most - least >= span:
        raise ValueError(f"keys from {least} to {most} are too far apart")
    levels = (most - least).bit_length() + 1
    at = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(F.col("_key") - least, k).alias("block")) for k in range(levels)])
    blocks = keys.select("_key", "n", (F.col("_key") * F.col("n")).alias("_sum"), F.explode(at).alias("_at")).groupBy("_at").agg(
        F.sum("n").alias("n"), F.min("_key").alias("first"), F.sum("_sum").alias("total")
    )
    a = F.greatest(F.ceil(low).cast("bigint"), F.lit(least)) - least
    b = F.least(F.floor(high).cast("bigint"), F.lit(most)) - least + 1  # the first number beyond
    sides = []
    for k in range(levels):
        left, right = F.shiftright(F.col("_a") + ((1 << k) - 1), k), F.shiftright("_b", k)
        block = lambda v: F.struct(F.lit(k).alias("level"), v.alias("block"))  # noqa: B023, E731
        sides.append(F.when((left < right) & (left % 2 == 1), block(left)))
        sides.append(F.when((left < right) & (right % 2 == 1), block(right - 1)))
    found = own.select("*", a.alias("_a"), b.alias("_b")).where("_a < _b").select(
        *own.columns, F.explode(F.array_compact(F.array(*sides))).alias("_at")
    )
    sums = found.join(blocks, "_at").groupBy(*own.columns).agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("total").alias("total")
    )
    again = F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int")))
    return sums.withColumn("_again", again).drop("_again", "_times")


def transform_old_entity(old: DataFrame, spec: DataFrame, loaded=None) -> DataFrame:
    """Redirects of the dataset in whose range the old entity lies: its collection must be the dataset's, and the
    target, if there is one, must lie in the same range."""
    old = C.snake_case(old).withColumns({"old_entity": C.as_long("old_entity"), "entity": C.as_long("entity")})
    own = spec.select(
        C.as_long("entity_minimum").alias("_low"),
        C.as_long("entity_maximum").alias("_high"),
        F.col("dataset"),
        F.col("collection").alias("_collection"),
    )
    found = range_join(old.drop("dataset"), own, "old_entity", "_low", "_high")
    found = found.where(
        (F.col("collection") == F.col("_collection")) & (
            F.col("entity").isNull() | F.col("entity").between(F.col("_low"), F.col("_high"))
        )
    )
    if loaded:
        found = found.withColumn(LOADED, F.lit(loaded).cast("timestamp"))
    return enforce(found, "old_entity", (LOADED,))


def with_dimension(df: DataFrame, dimension: DataFrame, on: str | list[str], blanks: tuple[str, ...] = ()) -> DataFrame:
    """Left join on a dimension; blanks: columns in which missing becomes ''."""
    out = df.join(dimension, on, "left")
    return C.fill_blank(out, *blanks) if blanks else out


def union_by_name(*frames: DataFrame, missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), frames)


def difference(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is not among other's."""
    return df.join(other, on, "left_anti")


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    from landloom.operators.history import pick

    return pick(df, keys, order)
