"""Flattening JSON text, GeoJSON text and feature trees into columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType, _parse_datatype_string


#: So many columns at most are made of keys that are found in the data.
MOST = 2000


def flatten_json(
    df: DataFrame, column: str = "json", keys: list[str] | None = None, most: int = MOST
) -> DataFrame:
    """A column per key of a JSON object; all rows are looked at for keys, unless they are given. Values are text. Fails
    where there are more than most keys."""
    parsed = F.from_json(column, "map<string,string>")
    if keys is None:
        found = df.select(F.explode(F.map_keys(parsed)).alias("k")).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{column} has more than {most} keys")
        keys = sorted(r.k for r in found)
    rest = [c for c in df.columns if c != column]
    return df.withColumn("_parsed", parsed).select(*rest, *[F.col("_parsed")[k].alias(k) for k in keys])


def json_schema(df: DataFrame, column: str = "json") -> StructType:
    """The type of a column of JSON objects over all rows, nested objects and arrays as they are. A member that is of
    several types, or null in all rows, is text. Rows that are no JSON count for nothing."""
    found = df.select(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first().s
    if found in (None, "VOID"):
        return StructType()
    if not found.startswith("OBJECT<"):
        raise ValueError(f"{column} holds other than JSON objects: {found[:60]}")
    outside = lambda old, new, text: "`".join(  # names stand in backticks where they are no plain words
        re.sub(old, new, part) if k % 2 == 0 else part for k, part in enumerate(text.split("`"))
    )
    kind = outside(r"\bOBJECT\b(?!:)", "STRUCT", found)
    kind = outside(r"\b(?:VARIANT|VOID)\b(?!:)", "STRING", kind)
    kind = _parse_datatype_string("STRUCT<>" if kind == "STRUCT<>" else kind)
    return kind


def flatten_typed(df: DataFrame, column: str = "json", most: int = MOST) -> DataFrame:
    """A typed column per member of a JSON object, by json_schema(). Fails where there are more than most."""
    schema = json_schema(df, column)
    if len(schema) > most:
        raise ValueError(f"{column} has {len(schema)} members, more than {most}")
    rest = [c for c in df.columns if c != column]
    if not len(schema):
        return df.select(*rest)
    parsed = df.withColumn("_parsed", F.from_json(column, schema))
    return parsed.select(*rest, *[F.col("_parsed").getField(f.name).alias(f.name) for f in schema])


GEOJSON = "type string, coordinates array<double>, properties map<string,string>"  # fixed value


def flatten_geojson(df: DataFrame, column: str = "geojson") -> DataFrame:
    """type, coordinates, longitude, latitude and properties of GeoJSON points."""
    rest = [c for c in df.columns if c != column]
    df = df.withColumn("_parsed", F.from_json(column, GEOJSON))
    at = F.col("_parsed.coordinates")
    return df.select(
        *rest,
        "_parsed.type",
        "_parsed.coordinates",
        F.get(at, 0).alias("longitude"),
        F.get(at, 1).alias("latitude"),
        "_parsed.properties",
    )


def flatten_features(df: DataFrame, name: str | None = None, value=None, attribute: str = "_attr_") -> DataFrame:
    """A text column per tag of a feature tree, attributes as tag_attribute; of repeated tags, and tags of one name, the
    last wins. name and value add a constant column, such as the source's name."""
    found: dict[str, object] = {}

    def walk(kind, at, tag: str) -> None:
        if isinstance(kind, ArrayType):
            walk(kind.elementType, F.try_element_at(at, F.lit(-1)), tag)
        elif isinstance(kind, StructType):
            for f in kind.fields:
                own = at.getField(f.name)
                if f.name.startswith(attribute):
                    found[f"{tag}_{f.name[len(attribute):]}"] = own.cast("string")
                elif f.name == "_VALUE":
                    found[tag] = own.cast("string")
                else:
                    walk(f.dataType, own, f.name)
        else:
            found[tag] = at.cast("string")

    for f in df.schema.fields:
        walk(f.dataType, F.col(f"`{f.name}`"), f.name)
    extra = [F.lit(value).alias(name)] if name else []
    return df.select(*[c.alias(n) for n, c in found.items()], *extra)
