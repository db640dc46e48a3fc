"""Follow-up tasks from fetch logs and data issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landloom.functions import columns as C
from landloom.operators.history import current_resources
from landloom.operators.joins import active, backfill, union_by_name
from landloom.plans.schema import schema_of

# fixed values
SEVERITIES = ("error", "warning", "notice")
TASK = [
    "dataset",
    "organisation",
    "endpoint",
    "resource",
    "details",
    "severity",
    "responsibility",
    "task_source",
    "entry_date",
    "reference",
]


def log_tasks(log: DataFrame, entry_date: str) -> DataFrame:
    """A task for each distinct failed fetch; repeated failures, on whatever days, are one."""
    own = ["dataset", "organisation", "endpoint", "resource", "status", "exception"]
    failed = log.where(F.col("status") != "200").select(*own).distinct()
    details = F.to_json(
        F.struct(F.col("status").try_cast("int").alias("status"), F.coalesce("exception", F.lit("")).alias("exception"))
    )
    out = C.with_constants(
        failed, details=details, severity="error", responsibility="external", task_source="log", entry_date=entry_date
    )
    return out.withColumn("reference", C.reference_of(*TASK[:4], "task_source", "details")).select(*TASK)


def issue_tasks(issues: DataFrame, entry_date: str) -> DataFrame:
    """A task for each (dataset, resource, field, issue type) and organisation of the ';' list, with the number of
    issues.

    Severity, responsibility and endpoint are the least of the group, so that reruns agree."""
    own = issues.where(F.col("severity").isin(*SEVERITIES)).withColumn(
        "organisation", F.explode(C.listed("organisation"))
    )
    by = own.groupBy("dataset", "resource", "field", "issue_type", "organisation").agg(
        F.count("*").alias("count"), *[F.min(c).alias(c) for c in ("severity", "responsibility", "endpoint")]
    )
    details = F.to_json(
        F.struct(
            F.coalesce("issue_type", F.lit("")).alias("issue_type"),
            F.col("count").cast("int").alias("count"),
            F.coalesce("field", F.lit("")).alias("field"),
        )
    )
    out = C.with_constants(by, details=details, task_source="issue", entry_date=entry_date)
    return out.withColumn("reference", C.reference_of(*TASK[:4], "task_source", "details")).select(*TASK)


def active_resources(log: DataFrame, attributes: DataFrame | None) -> DataFrame:
    """(resource, dataset, organisation, endpoint) that endpoints serve now; attributes(endpoint, dataset,
    organisation)."""
    now = current_resources(log)
    if attributes is None:
        now = C.with_constants(now, dataset="", organisation="")
    else:
        now = now.join(attributes, "endpoint", "left")
    return C.fill_blank(
        now.select("resource", "dataset", "organisation", "endpoint"), "dataset", "organisation"
    ).distinct()


def source_lookups(source: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(endpoint, dataset) exploded, (endpoint, organisation) and (endpoint, dataset list, organisation), of active
    sources.

    Where an endpoint is listed more than once, one row is kept: the least by organisation, then by list."""
    own = active(source)
    datasets = own.select("endpoint", F.explode(F.split("pipelines", ";")).alias("dataset")).distinct()
    one = own.groupBy("endpoint").agg(F.min(F.struct("organisation", "pipelines")).alias("s")).select(
        "endpoint", F.col("s.pipelines").alias("dataset"), F.col("s.organisation").alias("organisation")
    )
    return datasets, one.select("endpoint", "organisation"), one


def one_per_resource(active_: DataFrame) -> DataFrame:
    """A row per resource, whatever number of endpoints serve it, so that joining it multiplies nothing."""
    members = lambda c: F.array_join(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split(c, ";"))))), ";"
    ).alias(c)
    return active_.groupBy("resource").agg(
        members("dataset"), members("organisation"), F.min("endpoint").alias("endpoint")
    )


def all_tasks(
    log: DataFrame, source: DataFrame | None, issues: DataFrame | None, issue_types: DataFrame, entry_date: str
) -> DataFrame:
    """The cross-collection task table: failed fetches, their dataset and organisation filled from the resource or the
    source, and issues of resources that are served now."""
    lookups = source_lookups(source) if source is not None else None
    now = active_resources(log, lookups[2] if lookups else None)
    single = one_per_resource(now)
    logs = C.fill_blank(
        log.drop("dataset", "organisation").join(
            single.select("resource", "dataset", "organisation"), "resource", "left"
        ),
        "dataset",
        "organisation",
    )
    if lookups:
        logs = backfill(backfill(logs, lookups[0], "endpoint", "dataset"), lookups[1], "endpoint", "organisation")
    out = log_tasks(logs, entry_date)
    if issues is None:
        return out
    own = issues.drop("organisation", "endpoint").join(
        single.select("resource", "organisation", "endpoint"), "resource"
    )
    own = C.fill_blank(own, "organisation", "endpoint").join(issue_types, "issue_type", "left")
    return union_by_name(out, issue_tasks(own, entry_date)).to(schema_of("task"))
