"""Table schemas: enforcing them on frames, comparing them with stored tables, and migrating those."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landloom.sources import sinks

#: Set at load time, in no schema.
LOADED = "processed_timestamp"

# fixed values: the tables' columns and types
TABLES = {
    "entity": "dataset string, end_date date, entity bigint, entry_date date, geometry string, json string, name string, organisation_entity bigint, point string, prefix string, quality string, reference string, start_date date, typology string",
    "fact": "dataset string, end_date string, entity bigint, entry_date string, fact string, field string, priority int, reference_entity bigint, start_date string, value string",
    "fact_resource": "dataset string, end_date string, entry_date string, entry_number string, fact string, priority int, resource string, start_date string",
    "dataset_resource": "dataset string, entry_date string, entity_count int, entry_count int, line_count int, mime_type string, internal_path string, internal_mime_type string, resource string",
    "column_field": "dataset string, entry_date string, field string, resource string, column string",
    "old_entity": "old_entity bigint, status int, entity bigint, notes string, end_date date, entry_date date, start_date date, collection string, dataset string",
    "issue": "end_date string, entity bigint, entry_date string, entry_number string, field string, issue_type string, line_number string, dataset string, resource string, start_date string, value string, message string",
    "task": "dataset string, organisation string, endpoint string, resource string, details string, severity string, responsibility string, task_source string, entry_date string, reference string",
    "provision_quality": "dataset string, organisation string, organisation_name string, has_active_endpoint boolean, has_active_resource boolean, owns_entities boolean, is_designated_provider boolean, quality string, entity_count bigint, quality_score double",
    "dataset_quality": "dataset string, authoritative_organisations bigint, some_organisations bigint, total_organisations bigint, total_entities bigint, quality_score double",
    "organisation_quality": "organisation string, organisation_name string, authoritative_datasets bigint, some_datasets bigint, total_datasets bigint, total_entities_owned bigint, quality_score double",
}


def schema_of(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])


def enforce(df: DataFrame, schema: str | StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """One projection: known columns cast (null where that fails), missing ones null, others but keep dropped, in
    order."""
    schema = schema_of(schema) if isinstance(schema, str) else schema
    have = set(df.columns)

    def shaped(f):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        nested = dict(df.dtypes)[f.name].startswith(("struct", "array", "map"))
        if nested and f.dataType.simpleString() == "string":
            return F.to_json(f.name).alias(f.name)
        return (
            F.col(f.name) if df.schema[f.name].dataType == f.dataType else F.col(f.name).try_cast(f.dataType)
        ).alias(f.name)

    return df.select(*[shaped(f) for f in schema], *[k for k in keep if k in have and k not in schema.names])


def with_defaults(df: DataFrame, required: StructType, defaults: dict | None = None) -> DataFrame:
    """enforce(), with values for columns that df lacks."""
    extra = {k: F.lit(v) for k, v in (defaults or {}).items() if k not in df.columns}
    return enforce(df.withColumns(extra) if extra else df, required)


@dataclass
class Difference:
    added: dict[str, str] = field(default_factory=dict)
    removed: dict[str, str] = field(default_factory=dict)
    changed: dict[str, tuple[str, str]] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.changed)

    @property
    def destructive(self) -> bool:
        return bool(self.removed or self.changed)


def diff(spark: SparkSession, schema: str | StructType, path: str, fmt: str = "parquet") -> Difference:
    """What the schema has that the table at path lacks, and the reverse; empty where there is no table."""
    schema = schema_of(schema) if isinstance(schema, str) else schema
    if not sinks.exists(spark, path):
        return Difference()
    want = {f.name: f.dataType.simpleString() for f in schema}
    have = {f.name: f.dataType.simpleString() for f in spark.read.format(fmt).load(path).schema if f.name != LOADED}
    return Difference(
        {k: v for k, v in want.items() if k not in have},
        {k: v for k, v in have.items() if k not in want},
        {k: (have[k], want[k]) for k in want if k in have and have[k] != want[k]},
    )


def migrate(spark: SparkSession, schema: str | StructType, path: str, allow_destructive: bool = False, partition_by: tuple[str, ...] = (), fmt: str = "parquet") -> Difference:
    """Rewrite the table at path: new columns as nulls always, drops and casts only if allowed. Returns what was
    done."""
    schema = schema_of(schema) if isinstance(schema, str) else schema
    todo = diff(spark, schema, path, fmt)
    done = todo if allow_destructive else Difference(added=todo.added)
    if done:
        old = spark.read.format(fmt).load(path)
        if allow_destructive:
            new = enforce(old, schema, keep=(LOADED,))
        else:
            new = old.select("*", *[F.lit(None).cast(t).alias(c) for c, t in done.added.items()])
        sinks.swap(new, path, partition_by=partition_by, fmt=fmt)
    return done


def migrate_all(
    spark: SparkSession, tables: list[tuple[str | StructType, str]], **options
) -> dict[str, tuple[Difference, Difference]]:
    """migrate() each (schema or its name, path); by path: (what was done, what is still to be done, which is
    destructive)."""
    out = {}
    for name, path in tables:
        done = migrate(spark, name, path, **options)
        out[path] = done, diff(spark, name, path, options.get("fmt", "parquet"))
    return out


def report(spark: SparkSession, found: dict[str, tuple[Difference, Difference]]) -> DataFrame:
    """(path, state, action, column, before, after): a row for each change that migrate_all() made or left."""
    rows = []
    for path, both in found.items():
        for state, d in zip(("done", "pending"), both, strict=True):
            rows += [(path, state, "add", c, None, t) for c, t in d.added.items()]
            rows += [(path, state, "drop", c, t, None) for c, t in d.removed.items()]
            rows += [(path, state, "cast", c, a, b) for c, (a, b) in d.changed.items()]
    return spark.createDataFrame(
        rows, "path string, state string, action string, column string, before string, after string"
    )
