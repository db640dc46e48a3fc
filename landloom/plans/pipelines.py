"""Whole jobs: files in, tables and published files out. Each is a function of a session, paths and parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landloom.functions import columns as C
from landloom.functions import nested
from landloom.operators import history, joins, quality, stats, tasks
from landloom.sources import readers, sinks


def load_entities(
    spark: SparkSession,
    transformed: str,
    dataset: str,
    organisation: DataFrame,
    withdrawn: DataFrame | None,
    output: str,
    typology: str | DataFrame | None = None,
    loaded=None,
    publish: str | None = None,
    database: dict | None = None,
) -> dict[str, int]:
    """Collected values of a dataset to fact_resource, fact and entity tables, and published files. Returns row counts
    of what was read and of rows without a resource, which are left out."""
    eav = C.snake_case(readers.parquet(spark, transformed))
    if withdrawn is not None:
        eav = joins.drop_withdrawn(eav, withdrawn)
    seen, beside = Observation(), f"{output.rstrip('/')}/_history-{uuid.uuid4().hex}"
    eav = eav.observe(seen, F.count("*").alias("rows"), F.count_if(C.is_blank("resource")).alias("without_resource"))
    # three tables are made of it: read and joined once
    joins.drop_blank(eav, "resource").write.parquet(beside)
    eav = spark.read.parquet(beside)
    sinks.replace_partition(history.transform_fact_resource(eav, dataset, loaded), f"{output}/fact_resource", dataset)
    sinks.replace_partition(history.transform_fact(eav, dataset, loaded), f"{output}/fact", dataset)
    entity = history.transform_entity(eav, dataset, organisation, typology, loaded=loaded)
    sinks.replace_partition(entity, f"{output}/entity", dataset)
    sinks.remove(spark, beside)
    stored = spark.read.parquet(f"{output}/entity").where(F.col("dataset") == dataset)
    if publish:
        shown = C.kebab_case(stored)
        rows = stored.count()
        sinks.publish_file(shown, f"{publish}/{dataset}.csv", rows)
        sinks.publish_file(shown, f"{publish}/{dataset}.parquet", rows, "parquet")
        sinks.publish_json(stored, f"{publish}/{dataset}.json")
        sinks.publish_geojson(stored, f"{publish}/{dataset}.geojson", dataset)
    if database:
        sinks.jdbc_swap(stored, dataset=dataset, **database)
    return dict(seen.get)


def load_table(
    spark: SparkSession, name: str, source: str, dataset: str, output: str, withdrawn: DataFrame | None = None
) -> None:
    """issue, dataset_resource or column_field files of a dataset to its table."""
    df = readers.csv(spark, source)
    if withdrawn is not None:
        df = joins.drop_withdrawn(df, withdrawn)
    make = {
        "issue": history.transform_issue,
        "dataset_resource": history.transform_dataset_resource,
        "column_field": history.transform_column_field,
    }[name]
    sinks.replace_partition(make(df, dataset), f"{output}/{name}", dataset)


def load_old_entities(
    spark: SparkSession,
    pattern: str,
    spec: DataFrame,
    output: str,
    loaded=None,
    database: dict | None = None,
) -> DataFrame:
    """Redirects of all collections, tagged by folder, to one table."""
    columns = ["old_entity", "status", "entity", "notes", "end_date", "entry_date", "start_date"]
    out = joins.transform_old_entity(readers.tagged(spark, pattern, columns), spec, loaded)
    sinks.overwrite(out, f"{output}/old_entity")
    stored = spark.read.parquet(f"{output}/old_entity")
    if database:
        sinks.jdbc_swap(stored, **database)
    return stored


def generate_tasks(
    spark: SparkSession, base: str, issue_types: DataFrame, output: str, entry_date: str, database: dict | None = None
) -> DataFrame:
    """Logs, sources and issues of all collections to the task table."""
    log = readers.csv_by_name(
        spark,
        readers.discover(spark, f"{base}/*-collection/collection/log.csv"),
        ["endpoint", "resource", "status", "entry_date", "exception"],
        missing=True,
    )
    sources = readers.discover(spark, f"{base}/*-collection/collection/source.csv")
    source = readers.csv_by_name(
        spark, sources, ["endpoint", "pipelines", "organisation", "end_date"], missing=True
    ) if sources else None
    found = readers.discover(spark, f"{base}/*-collection/issue/*/*.csv")
    issues = readers.csv_by_name(
        spark, found, ["resource", "dataset", "field", "issue_type"], missing=True
    ) if found else None
    sinks.overwrite(tasks.all_tasks(log, source, issues, issue_types, entry_date), f"{output}/task")
    stored = spark.read.parquet(f"{output}/task")
    if database:
        sinks.jdbc_swap(stored, **database)
    return stored


def active_providers(source: DataFrame, resource: DataFrame) -> DataFrame:
    """(dataset, organisation, has_active_resource): providers with an active endpoint, and whether one still
    delivers."""
    own = joins.active(source).where(~C.is_blank("endpoint") & ~C.is_blank("organisation"))
    own = own.select("endpoint", "organisation", F.explode(F.split("pipelines", ";")).alias("dataset"))
    delivering = joins.active(resource).select(
        F.explode(F.split("endpoints", ";")).alias("endpoint")
    ).distinct().withColumn("_delivers", F.lit(True))
    return own.join(delivering, "endpoint", "left").groupBy("dataset", "organisation").agg(
        F.coalesce(F.max("_delivers"), F.lit(False)).alias("has_active_resource")
    )


def provision_quality(
    spark: SparkSession,
    base: str,
    organisation: DataFrame,
    designated: DataFrame,
    datasets: DataFrame,
    entity_files: list[str],
    output: str,
    environment: str = "production",
    database: dict[str, dict] | None = None,
) -> dict[str, DataFrame]:
    """Quality of provision per dataset and organisation, with both roll-ups, as tables and CSV files."""
    source = readers.csv_by_name(
        spark,
        readers.discover(spark, f"{base}/*-collection/collection/source.csv"),
        ["endpoint", "pipelines", "organisation", "end_date"],
    )
    resource = readers.csv_by_name(
        spark,
        readers.discover(spark, f"{base}/*-collection/collection/resource.csv"),
        ["resource", "endpoints", "end_date"],
    )
    lookup = readers.csv_by_name(
        spark, readers.discover(spark, f"{base}/config/pipeline/*/lookup.csv"), ["entity", "organisation"]
    )
    people = organisation.select(
        "organisation",
        F.col("entity").alias("organisation_entity"),
        F.col("name").alias("organisation_name"),
        C.is_blank("end_date").alias("org_active"),
    )
    pq = quality.provision_quality(
        active_providers(source, resource),
        people,
        designated,
        lookup.where(~C.is_blank("organisation")),
        readers.entity_quality(spark, entity_files),
    )
    pq = quality.drop_blank_organisations(pq.join(quality.live_datasets(datasets, environment), "dataset", "left_semi"))
    sinks.overwrite(pq, f"{output}/provision_quality")
    pq = spark.read.parquet(f"{output}/provision_quality")
    out = {
        "provision_quality": pq.orderBy("dataset", F.lower("organisation_name").asc_nulls_last()),
        "dataset_quality": quality.dataset_quality(pq).orderBy("dataset"),
        "organisation_quality": quality.organisation_quality(pq).orderBy(F.lower("organisation_name")),
    }
    for name, df in out.items():
        if name != "provision_quality":
            sinks.overwrite(df, f"{output}/{name}")
        sinks.single_file(df, f"{output}/{name}.csv")
        if database and name in database:
            sinks.jdbc_swap(df, **database[name])
    return out


def cadastral_study(spark: SparkSession, archives: str | DataFrame, work: str) -> tuple[DataFrame, DataFrame]:
    """(volume per archive, records per archive) of zipped cadastral XML, at paths that match a pattern or in
    archives(path, content): executors unpack members and write their features as documents of their own, which name the
    archive; those are read back and flattened to Parquet."""
    members = readers.archive_members(spark, archives) if isinstance(archives, str) else readers.members_of(archives)
    members.write.mode("overwrite").parquet(f"{work}/members")
    members = spark.read.parquet(f"{work}/members")
    features = readers.features_of(members.select(F.col("archive").alias("council_name"), "text"))
    name = F.replace(F.replace("council_name", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    opening = F.regexp_extract("feature", "^<[^>]*>", 0)
    rest = F.substring("feature", F.length(opening) + 1, F.length("feature"))
    sinks.write_xml(
        features.select(
            F.concat(opening, F.lit("<council_name>"), name, F.lit("</council_name>"), rest).alias("value")
        ),
        f"{work}/xml",
    )
    flat = nested.flatten_features(readers.xml_features(spark, f"{work}/xml"))
    flat.write.mode("overwrite").parquet(f"{work}/features")
    volume = stats.archive_volume(members.select("archive", "member", "size"))
    return volume, stats.records_per_group(spark.read.parquet(f"{work}/features"), "council_name")
