"""Entity-attribute-value histories: current values, first facts, wide entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landloom.functions import columns as C
from landloom.functions import geometry as G
from landloom.plans.schema import LOADED, enforce

#: Columns of a wide entity that have a place of their own; all others go into json.
STANDARD = (
    "dataset",
    "end_date",
    "entity",
    "entry_date",
    "geometry",
    "json",
    "name",
    "organisation_entity",
    "point",
    "prefix",
    "quality",
    "reference",
    "start_date",
    "typology",
)


#: A list of so many datasets at most is broadcast.
MAX_DATASETS = 100_000


def pick(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; list enough columns that ties are equal in what matters."""
    return df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ).where("_rank = 1").drop("_rank")


def _numeric(c: str, descending: bool) -> list[Column]:
    """By number, then by text where it is none: '10' comes after '2'."""
    by = [C.as_long(c), F.col(c).cast("string")]
    return [b.desc_nulls_last() if descending else b.asc_nulls_first() for b in by]


def latest_values(eav: DataFrame) -> DataFrame:
    """The current row of each (entity, field): latest entry_date, then highest priority if there is one, then
    entry_number."""
    order = [
        F.col("entry_date").desc_nulls_last(),
        *(_numeric("priority", True) if "priority" in eav.columns else []),
        *_numeric("entry_number", True),
        F.col("value").asc_nulls_last(),
    ]
    return pick(eav, ["entity", "field"], order)


def first_facts(eav: DataFrame) -> DataFrame:
    """The first row of each fact: lowest priority, earliest entry_date, lowest entry_number."""
    return pick(
        eav,
        ["fact"],
        [*_numeric("priority", False), F.col("entry_date").asc_nulls_first(), *_numeric("entry_number", False)],
    )


def current_resources(log: DataFrame) -> DataFrame:
    """(endpoint, resource): what each endpoint served last with success; of one date, the first by name."""
    good = log.where((F.col("status") == "200") & ~C.is_blank("resource"))
    return pick(
        good, ["endpoint"], [F.col("entry_date").desc_nulls_last(), F.col("resource")]
    ).select("endpoint", "resource")


def pivot(eav: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """A row per entity with a column per field and max_priority. One aggregation; without fields, a job finds them
    first.

    Rows of a null field carry no value. eav holds one row per (entity, field)."""
    if fields is None:
        fields = [r.field for r in eav.select("field").where("field IS NOT NULL").distinct().orderBy("field").collect()]
    best = F.max(C.as_long("priority")) if "priority" in eav.columns else F.lit(None).cast("bigint")
    return eav.groupBy("entity").agg(
        best.alias("max_priority"), *[F.min(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    )


def join_organisation(df: DataFrame, organisation: DataFrame) -> DataFrame:
    """Add organisation_entity of the organisation code; a code listed twice counts once, the smallest entity."""
    own = organisation.groupBy("organisation").agg(F.min("entity").alias("organisation_entity"))
    df = df if "organisation" in df.columns else df.withColumn("organisation", F.lit(None).cast("string"))
    return df.drop("organisation_entity").join(own, "organisation", "left")


def join_typology(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Add the typology of the dataset from dimension(dataset, typology); of several the least, null where there is
    none."""
    own = dimension.groupBy("dataset").agg(F.min("typology").alias("typology"))
    return df.drop("typology").join(
        F.broadcast(own) if own.limit(MAX_DATASETS + 1).count() <= MAX_DATASETS else own, "dataset", "left"
    )


def transform_fact_resource(eav: DataFrame, dataset: str, loaded=None) -> DataFrame:
    return enforce(
        C.with_constants(eav, dataset=dataset, **({LOADED: F.lit(loaded).cast("timestamp")} if loaded else {})),
        "fact_resource",
        (LOADED,),
    )


def transform_fact(eav: DataFrame, dataset: str, loaded=None) -> DataFrame:
    return enforce(
        C.with_constants(
            first_facts(eav), dataset=dataset, **({LOADED: F.lit(loaded).cast("timestamp")} if loaded else {})
        ),
        "fact",
        (LOADED,),
    )


def transform_entity(
    eav: DataFrame,
    dataset: str,
    organisation: DataFrame,
    typology: str | DataFrame | None = None,
    fields: list[str] | None = None,
    loaded=None,
) -> DataFrame:
    """Wide entities: current values pivoted, quality from the highest priority, the owner's entity, what has no column
    of its own as JSON, dates and geometry checked, and a point for each geometry. typology: the value for all, or a
    table to look it up in (see join_typology())."""
    wide = C.snake_case(pivot(latest_values(eav), fields))
    has_priority = "priority" in eav.columns
    wide = C.with_constants(wide, dataset=dataset, quality=C.quality_of("max_priority") if has_priority else F.lit(""))
    if isinstance(typology, DataFrame):
        wide = join_typology(wide, typology)
    elif typology is not None or "typology" not in wide.columns:
        wide = wide.withColumn("typology", F.lit(typology))
    wide = join_organisation(wide.drop("max_priority"), organisation)
    rest = [c for c in wide.columns if c not in STANDARD and c != "organisation"]
    for c in ("geometry", "end_date", "entry_date", "start_date", "name", "point", "prefix", "reference"):
        if c not in wide.columns:
            wide = wide.withColumn(c, F.lit(None).cast("string"))
    dated = {c: C.as_date(c) for c in ("end_date", "entry_date", "start_date")}
    out = wide.withColumns(
        {
            "json": C.pack_json(rest),
            "geometry": C.known_geometry("geometry"),
            "point": C.known_geometry("point"),
            **dated,
        }
    )
    if loaded:
        out = out.withColumn(LOADED, F.lit(loaded).cast("timestamp"))
    return G.with_centroid(enforce(out, "entity", (LOADED,)))


def transform_issue(df: DataFrame, dataset: str, entry_date: str | None = None) -> DataFrame:
    """Issues of a dataset; those of no resource go."""
    extra = {c: F.lit("") for c in ("start_date", "end_date") if c not in df.columns}
    if entry_date is not None:
        extra["entry_date"] = F.lit(entry_date)
    return enforce(C.with_constants(df.where("resource IS NOT NULL"), dataset=dataset, **extra), "issue")


def transform_dataset_resource(df: DataFrame, dataset: str) -> DataFrame:
    return enforce(C.with_constants(df, dataset=dataset), "dataset_resource")


def transform_column_field(df: DataFrame, dataset: str) -> DataFrame:
    return enforce(C.with_constants(df, dataset=dataset), "column_field")
