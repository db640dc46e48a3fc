"""Who provides, owns and seeds data, and how good it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landloom.functions import columns as C

# fixed values
LOCAL_AUTHORITIES = ("local-authority:", "national-park-authority:", "development-corporation:")
BUILT_IN = {
    "production": ("production",),
    "staging": ("production", "staging"),
    "development": ("production", "staging", "development"),
}
KEY = ["dataset", "organisation"]


def live_datasets(datasets: DataFrame, environment: str) -> DataFrame:
    """Datasets that are built in an environment and not retired; a blank environment is built nowhere."""
    return datasets.where(
        F.col("environment").isin(*BUILT_IN.get(environment, ("production",))) & C.is_blank("end_date")
    ).select("dataset").distinct()


def owner_side(owned: DataFrame) -> DataFrame:
    """Per (dataset, organisation) that owns entities: authoritative if one of them is, else some; and how many."""
    best = F.max(F.coalesce(F.col("quality") == "authoritative", F.lit(False)))
    return owned.groupBy(*KEY).agg(
        F.lit(True).alias("owns_entities"),
        F.when(best, "authoritative").otherwise("some").alias("owner_quality"),
        F.countDistinct("entity").alias("owned_entity_count"),
    )


def seeder_side(
    owned: DataFrame, lookup: DataFrame, designated: DataFrame, active_organisations: DataFrame
) -> DataFrame:
    """Active organisations that seeded entities of quality some in a dataset where they own none and are not
    designated.

    Local authorities count only if they seeded for more than one owner. owners is exact up to 1 and at least 2 beyond."""
    some = owned.where((F.col("quality") == "some") & F.col("entity").isNotNull()).select(
        "dataset", "entity", F.col("organisation").alias("owner")
    )
    # one row per entity and one per (entity, organisation), dealt alike: joined rows are counted, not told apart again
    each = some.repartition("entity").groupBy("dataset", "entity").agg(
        F.min("owner").alias("owner"), F.coalesce(F.min("owner") < F.max("owner"), F.lit(False)).alias("_several")
    )
    now = lookup.where(F.col("entity").isNotNull()).select("entity", "organisation").repartition("entity").distinct()
    by = each.join(now, "entity").groupBy(*KEY).agg(
        (F.countDistinct("owner") + F.max(F.col("_several").cast("int"))).alias("owners"),
        F.count("*").alias("seeder_entity_count"),
    )
    by = by.join(active_organisations.select("organisation"), "organisation", "left_semi")
    for others in (
        some.select("dataset", F.col("owner").alias("organisation")).distinct(), designated.select(*KEY).distinct()
    ):
        by = by.join(others, KEY, "left_anti")
    local = F.lit(False)
    for prefix in LOCAL_AUTHORITIES:
        local = local | F.col("organisation").startswith(prefix)
    return by.where(F.col("owners") >= F.when(local, 2).otherwise(1)).select(
        *KEY, F.lit("some").alias("seeder_quality"), "seeder_entity_count"
    )


def provision_quality(
    providers: DataFrame, organisations: DataFrame, designated: DataFrame, lookup: DataFrame, entity_quality: DataFrame
) -> DataFrame:
    """One row per (dataset, organisation) that has an active endpoint, owns entities or seeds them.

    The five sides are brought to one shape and aggregated by key once, instead of being joined one by one."""
    owned = entity_quality.join(
        organisations.select("organisation", "organisation_entity").distinct(), "organisation_entity"
    )
    own = owner_side(owned)
    seed = seeder_side(owned, lookup, designated, organisations.where("org_active").select("organisation").distinct())
    flags = {
        "provider": providers.select(*KEY, "has_active_resource", F.lit(True).alias("has_active_endpoint")),
        "owner": own,
        "seeder": seed,
        "designated": designated.select(*KEY, F.lit(True).alias("is_designated_provider")),
    }
    parts = [df.withColumn("_keeps", F.lit(k != "designated")) for k, df in flags.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    values = [
        "has_active_endpoint",
        "has_active_resource",
        "owns_entities",
        "is_designated_provider",
        "owner_quality",
        "owned_entity_count",
        "seeder_quality",
        "seeder_entity_count",
    ]
    by = every.groupBy(*KEY).agg(F.max("_keeps").alias("_keeps"), *[F.max(v).alias(v) for v in values]).where("_keeps")
    names = organisations.groupBy("organisation").agg(F.min("organisation_name").alias("organisation_name"))
    yes = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return by.join(names, "organisation", "left").select(
        *KEY, "organisation_name", *[yes(v) for v in values[:4]], F.coalesce("owner_quality", "seeder_quality").alias("quality"),
        F.coalesce("owned_entity_count", "seeder_entity_count", F.lit(0)).alias("entity_count"), F.lit(None).cast("double").alias("quality_score"),
    )


def _roll_up(pq: DataFrame, by: str, of: str, names: tuple[str, str, str, str], *more) -> DataFrame:
    grade = lambda g: F.countDistinct(F.when(F.col("quality") == g, F.col(of)))
    owned = F.sum(F.when(F.col("owns_entities"), F.col("entity_count")).otherwise(0))
    out = pq.where("quality IS NOT NULL").groupBy(by).agg(
        *more,
        grade("authoritative").alias(names[0]),
        grade("some").alias(names[1]),
        F.countDistinct(of).alias(names[2]),
        owned.alias(names[3]),
    )
    return out.withColumn("quality_score", F.lit(None).cast("double"))


def dataset_quality(pq: DataFrame) -> DataFrame:
    """Per dataset: authoritative, some and all organisations, and the entities that are owned."""
    return _roll_up(
        pq,
        "dataset",
        "organisation",
        ("authoritative_organisations", "some_organisations", "total_organisations", "total_entities"),
    )


def organisation_quality(pq: DataFrame) -> DataFrame:
    """The same per organisation, with its name."""
    return _roll_up(
        pq,
        "organisation",
        "dataset",
        ("authoritative_datasets", "some_datasets", "total_datasets", "total_entities_owned"),
        F.min("organisation_name").alias("organisation_name"),
    )


def drop_blank_organisations(df: DataFrame) -> DataFrame:
    return df.where(~C.is_blank("organisation"))
