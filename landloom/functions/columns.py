"""Column expressions over loosely typed text. A blank string and null both mean missing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values
GEOMETRY_KINDS = ("POINT", "POLYGON", "MULTIPOLYGON")
QUALITY_OF_PRIORITY = {1: "some", 2: "authoritative"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    return F.coalesce(_c(c) == "", F.lit(True))


def blank_to_null(c) -> Column:
    return F.nullif(_c(c), F.lit(""))


def as_long(c) -> Column:
    """A whole number, or null where the text is none."""
    return _c(c).try_cast("bigint")


def as_date(c) -> Column:
    """An ISO date, or null where the text is blank or none."""
    return F.to_date(F.try_to_timestamp(blank_to_null(c), F.lit("yyyy-MM-dd")))


def quality_of(priority) -> Column:
    """some for priority 1, authoritative for 2, else blank."""
    n, out = as_long(priority), F.lit("")
    for k, label in QUALITY_OF_PRIORITY.items():
        out = F.when(n == k, label).otherwise(out)
    return out


def known_geometry(c) -> Column:
    """Geometry text of a supported kind, else null."""
    kinds = [_c(c).startswith(k) for k in GEOMETRY_KINDS]
    return F.when(kinds[0] | kinds[1] | kinds[2], _c(c))


def reference_of(*columns) -> Column:
    """A stable key: the first 16 hex digits of the SHA-256 of the columns, null counting as blank."""
    return F.substring(
        F.sha2(F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in columns]), 256), 1, 16
    )


def listed(c, separator: str = ";") -> Column:
    """The distinct members of a delimited list."""
    return F.array_distinct(F.split(_c(c), separator))


def pack_json(columns: Iterable[str]) -> Column:
    """All columns as one JSON text with sorted keys; nulls are left out."""
    names = sorted(columns)
    return F.to_json(F.struct(*names)) if names else F.lit("{}")


def fill_blank(df: DataFrame, *columns: str) -> DataFrame:
    return df.fillna("", subset=list(columns))


def snake_case(df: DataFrame) -> DataFrame:
    """Rename a-b to a_b; fails where two columns would get one name."""
    names = [c.replace("-", "_") for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns would collide: {sorted(n for n in names if names.count(n) > 1)}")
    return df.toDF(*names)


def kebab_case(df: DataFrame) -> DataFrame:
    """Rename a_b to a-b, for publishing."""
    return df.toDF(*[c.replace("_", "-") for c in df.columns])


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Add constant columns; what depends on the clock is passed in, so that reruns agree."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})


def with_missing(df: DataFrame, fields: Iterable[str], value: str = "") -> DataFrame:
    """Append the fields that df lacks."""
    return df.select("*", *[F.lit(value).alias(f) for f in fields if f not in df.columns])
