"""Further registered queries: readers, sinks and whole jobs over files that Spark writes from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from landloom import queries as Q
from landloom.functions import columns as C
from landloom.functions import geometry as G
from landloom.functions import nested
from landloom.operators import history, joins, quality, stats
from landloom.plans import pipelines
from landloom.plans import schema as S
from landloom.queries import DAY, ORACLE_SQL, QUERIES, query, t, text
from landloom.sources import readers, sinks

__all__ = ["ORACLE_SQL", "QUERIES"]


def csv(df: DataFrame, path: str) -> None:
    df.write.option("header", "true").csv(path)


# ------------------------------------------------------------------------------------------------- readers


@query(
    """SELECT c_custkey::VARCHAR AS cust_key, c_name AS full_name, c_nationkey::VARCHAR AS nation_key FROM customer"""
)
def csv_snake_case(spark, sf_dir):
    at = Q.folder(spark)
    csv(
        t(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("cust-key"),
            F.col("c_name").alias("full-name"),
            F.col("c_nationkey").alias("nation-key"),
        ),
        at,
    )
    return readers.csv(spark, f"{at}/*.csv")


@query(
    """SELECT 'r' || o_orderkey AS old_resource, CASE o_orderstatus WHEN 'F' THEN '410' ELSE '301' END AS status, 'r' || o_custkey AS resource FROM orders"""
)
def old_resources(spark, sf_dir):
    at = Q.folder(spark)
    status = F.when(F.col("o_orderstatus") == "F", "410").otherwise("301")
    csv(
        t(spark, sf_dir, "orders").select(
            F.concat(F.lit("r"), text("o_orderkey")).alias("old-resource"),
            status.alias("status"),
            F.concat(F.lit("r"), text("o_custkey")).alias("resource"),
            F.lit("x").alias("notes"),
        ),
        at,
    )
    return readers.old_resources(spark, at)


OWNED_NATIONS = "SELECT c_mktsegment AS dataset, o_orderkey AS entity, c_nationkey AS organisation_entity, CASE o_orderpriority WHEN '1-URGENT' THEN 'authoritative' WHEN '5-LOW' THEN NULL ELSE 'some' END AS quality FROM orders JOIN customer ON c_custkey = o_custkey"


def _entity_files(spark, sf_dir, at: str) -> list[str]:
    """A file of entities per dataset, and one that has other columns."""
    owned = Q._owned(spark, sf_dir).select(
        "dataset", "entity", F.col("organisation_entity").alias("organisation-entity"), "quality"
    )
    sinks.file_per_value(owned, at, "dataset")
    sinks.single_file(t(spark, sf_dir, "nation").select("n_name"), f"{at}/other.csv")
    return readers.discover(spark, f"{at}/*.csv")


@query(
    f"""SELECT dataset, entity::VARCHAR AS entity, organisation_entity::VARCHAR AS organisation_entity, quality FROM ({
        OWNED_NATIONS
    })"""
)
def entity_quality(spark, sf_dir):
    return readers.entity_quality(spark, _entity_files(spark, sf_dir, Q.folder(spark)))


@query("""SELECT p_partkey, p_size, round(p_retailprice, 2) AS p_retailprice, p_name FROM part""")
def csv_inferred(spark, sf_dir):
    at = Q.folder(spark)
    t(spark, sf_dir, "part").select(
        "p_partkey", "p_size", F.round("p_retailprice", 2).alias("p_retailprice"), "p_name"
    ).write.option("header", "true").option("sep", ";").csv(at)
    out = readers.csv_inferred(spark, at, sep=";")
    kinds = dict(out.dtypes)
    if (kinds["p_partkey"], kinds["p_retailprice"], kinds["p_name"]) != ("int", "double", "string"):
        raise ValueError(f"types inferred: {kinds}")
    return out.select(F.col("p_partkey").cast("long"), F.col("p_size").cast("long"), "p_retailprice", "p_name")


@query("""SELECT 'stored' AS origin, o_orderstatus, count(*) AS records FROM orders GROUP BY o_orderstatus""")
def table_or_empty(spark, sf_dir):
    """A stored table and one that isn't there, which reads as no rows of the right columns."""
    at = Q.folder(spark)
    sinks.overwrite(t(spark, sf_dir, "orders").select(text("o_orderkey"), "o_orderstatus"), f"{at}/orders")
    sides = [
        readers.table_or_empty(spark, f"{at}/{n}", ["o_orderkey", "o_orderstatus"]).withColumn("origin", F.lit(o))
        for n, o in (("orders", "stored"), ("missing", "none"))
    ]
    return joins.union_by_name(*sides).groupBy("origin", "o_orderstatus").agg(F.count("*").alias("records"))


# ------------------------------------------------------------------------------------------------- sinks


@query("""SELECT l_suppkey, count(*) AS records FROM lineitem GROUP BY l_suppkey""")
def published_parquet(spark, sf_dir):
    at = Q.folder(spark)
    sinks.single_file(
        stats.records_per_group(t(spark, sf_dir, "lineitem"), "l_suppkey"), f"{at}/out.parquet", "parquet"
    )
    return spark.read.parquet(f"{at}/out.parquet")


@query(
    """SELECT c_nationkey::VARCHAR AS c_nationkey, count(*)::VARCHAR AS records, '' AS since FROM customer GROUP BY c_nationkey"""
)
def json_envelope(spark, sf_dir):
    at = Q.folder(spark)
    counts = stats.records_per_group(
        t(spark, sf_dir, "customer"), "c_nationkey"
    ).withColumn("since", F.lit(None).cast("date"))
    sinks.publish_json(counts, f"{at}/out.json")
    held = spark.read.text(f"{at}/out.json").select(
        F.explode(F.from_json("value", "struct<entities:array<map<string,string>>>")["entities"]).alias("e")
    )
    return held.select(*[F.col("e")[c].alias(c) for c in ("c_nationkey", "records", "since")])


SHAPE = f"CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE {Q.GEOJSON} END"


def _features(spark, sf_dir) -> DataFrame:
    return Q._shapes(spark, sf_dir).withColumns(
        {"geometry": F.when(F.col("c_custkey") % 11 > 0, F.col("geometry")), "point": F.lit("")}
    )


@query(
    f"""SELECT c_custkey::VARCHAR AS c_custkey, c_nationkey::VARCHAR AS c_nationkey, 'Feature' AS type, {
        SHAPE
    } AS geometry FROM customer"""
)
def geojson_lines(spark, sf_dir):
    at = Q.folder(spark)
    sinks.write_lines(sinks.feature_rows(_features(spark, sf_dir)), at)
    part = lambda x: F.get_json_object("value", f"$.{x}")
    rows = spark.read.text(at)
    return rows.select(
        part("properties.c_custkey").alias("c_custkey"),
        part("properties.c_nationkey").alias("c_nationkey"),
        part("type").alias("type"),
        part("geometry").alias("geometry"),
    )


@query(
    """SELECT c_nationkey::VARCHAR AS c_nationkey, 'nations' AS name, '{"type":"Point","coordinates":[' || count(*) || '.0,' || (c_nationkey + 1) || '.0]}' AS geometry FROM customer GROUP BY c_nationkey"""
)
def geojson_collection(spark, sf_dir):
    at = Q.folder(spark)
    counts = stats.records_per_group(t(spark, sf_dir, "customer"), "c_nationkey")
    point = F.concat(
        F.lit("POINT ("), text("records"), F.lit(" "), (F.col("c_nationkey") + 1).cast("string"), F.lit(")")
    )
    sinks.publish_geojson(
        counts.select("c_nationkey", point.alias("point"), F.lit(None).cast("string").alias("geometry")),
        f"{at}/out.geojson",
        "nations",
    )
    parsed = F.from_json(
        "value",
        "struct<name:string,features:array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:array<double>>>>>",
    )
    held = spark.read.text(f"{at}/out.geojson").select(parsed.alias("d")).select(
        "d.name", F.explode("d.features").alias("f")
    )
    return held.select(
        F.col("f.properties")["c_nationkey"].alias("c_nationkey"), "name", F.to_json("f.geometry").alias("geometry")
    )


@query(
    """SELECT c_custkey AS "C_CUSTKEY", CASE WHEN 100 + c_custkey % 300 + CASE WHEN c_custkey % 3 = 0 THEN 9 ELSE 4 END > 256 THEN 2 ELSE 1 END AS "FRAGMENTS" FROM customer"""
)
def jdbc_subdivided(spark, sf_dir):
    url, name = Q.database(spark), f"PIECES{uuid.uuid4().hex[:8]}".upper()
    rows = Q._strips(spark, sf_dir).select(
        F.col("c_custkey").alias("C_CUSTKEY"), F.lit("strip").alias("DATASET"), F.col("geometry").alias("GEOMETRY")
    )
    types = "DATASET VARCHAR(32), GEOMETRY VARCHAR(30000)"
    rows.limit(0).write.option("createTableColumnTypes", types).jdbc(url, name)
    sinks.jdbc_subdivided(rows, url, name, "strip", geometry="GEOMETRY", types=types)
    return spark.read.jdbc(url, name).groupBy("C_CUSTKEY").agg(F.count("*").cast("int").alias("FRAGMENTS"))


@query("""SELECT o_orderkey AS "O_ORDERKEY", o_orderstatus AS "O_ORDERSTATUS" FROM orders""")
def jdbc_sized(spark, sf_dir):
    """A relational copy in as many tasks and batches as its number of rows asks for."""
    url, name = Q.database(spark), f"SIZED{uuid.uuid4().hex[:8]}".upper()
    rows = t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_orderstatus").alias("O_ORDERSTATUS")
    )
    types = "O_ORDERSTATUS VARCHAR(4)"
    rows.limit(0).write.option("createTableColumnTypes", types).jdbc(url, name)
    sinks.jdbc_swap(rows, url, name, checked=True, rows=rows.count(), types=types)
    return spark.read.jdbc(url, name)


@query("""SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment || ', "quoted"' END AS note FROM customer""")
def published_csv(spark, sf_dir):
    """Delimited text in one file, written in parts."""
    at = Q.folder(spark)
    note = F.when(F.col("c_custkey") % 3 > 0, F.concat("c_mktsegment", F.lit(', "quoted"')))
    rows = t(spark, sf_dir, "customer").select("c_custkey", "c_name", note.alias("note"))
    sinks.publish_file(rows, f"{at}/out.csv", 10**6 * 3)
    return spark.read.csv(f"{at}/out.csv", header=True, schema="c_custkey long, c_name string, note string")


@query("""SELECT o_orderkey AS "O_ORDERKEY", o_orderstatus AS "O_ORDERSTATUS" FROM orders""")
def jdbc_table(spark, sf_dir):
    """A whole relational table replaced by another one, with its columns in the target's order."""
    url, name = Q.database(spark), f"ALL{uuid.uuid4().hex[:8]}".upper()
    rows = t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_orderstatus").alias("O_ORDERSTATUS")
    )
    types = "O_ORDERSTATUS VARCHAR(4)"
    rows.withColumn("O_ORDERSTATUS", F.lit("?")).write.option("createTableColumnTypes", types).jdbc(url, name)
    sinks.jdbc_swap(rows.select("O_ORDERSTATUS", "O_ORDERKEY"), url, name, checked=True, types=types)
    return spark.read.jdbc(url, name)


@query("""SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand AS brand FROM part""")
def file_conversion(spark, sf_dir):
    at = Q.folder(spark)
    t(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_brand").alias("brand")).write.parquet(f"{at}/in")
    sinks.convert(spark, f"{at}/in", f"{at}/out", "brand")
    return spark.read.option("header", "true").csv(f"{at}/out")


@query("""SELECT count(*) AS records, true AS bounded FROM lineitem""")
def split_files(spark, sf_dir):
    at = Q.folder(spark)
    sinks.split_files(t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), at, 1500)
    files = spark.read.option("header", "true").csv(at).groupBy(
        F.col("_metadata.file_path").alias("f")
    ).agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("records"), (F.max("n") <= 1500).alias("bounded"))


@query(
    """WITH c AS (SELECT l_returnflag, count(*) AS records FROM lineitem GROUP BY l_returnflag) SELECT 'csv' AS kind, l_returnflag, records FROM c UNION ALL SELECT 'parquet', l_returnflag, records FROM c"""
)
def report(spark, sf_dir):
    at = Q.folder(spark)
    sinks.report(stats.records_per_group(t(spark, sf_dir, "lineitem"), "l_returnflag"), f"{at}/modes")
    as_csv = spark.read.option("header", "true").csv(f"{at}/modes.csv").select(
        F.lit("csv").alias("kind"), "l_returnflag", F.col("records").cast("long")
    )
    return as_csv.unionByName(spark.read.parquet(f"{at}/modes.parquet").withColumn("kind", F.lit("parquet")))


# ------------------------------------------------------------------------------------------------- columns and filters


@query("""SELECT c_custkey AS "c-custkey", c_name AS "c-name", '' AS "end-date" FROM customer""")
def kebab_case(spark, sf_dir):
    return C.kebab_case(
        C.with_missing(t(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_name", "end_date"])
    )


@query(
    """SELECT o_orderkey AS entity, json_object('priority', o_orderpriority, 'status', o_orderstatus)::VARCHAR AS details, 'order' AS kind, NULL::BIGINT AS parent FROM orders"""
)
def with_defaults(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("entity"),
        F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")).alias("details"),
        F.lit(1).alias("extra"),
    )
    return S.with_defaults(
        rows, S.StructType.fromDDL("entity bigint, details string, kind string, parent bigint"), {"kind": "order"}
    )


@query(
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'POINT (1 2)' WHEN 1 THEN 'POLYGON ((0 0, 1 0, 1 1, 0 0))' WHEN 2 THEN 'MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))' END AS geometry FROM customer"""
)
def known_geometry(spark, sf_dir):
    kinds = F.array(
        *[
            F.lit(x) for x in (
                "POINT (1 2)",
                "POLYGON ((0 0, 1 0, 1 1, 0 0))",
                "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))",
                "LINESTRING (0 0, 1 1)",
                "",
            )
        ]
    )
    return t(spark, sf_dir, "customer").select(
        "c_custkey", C.known_geometry(F.get(kinds, (F.col("c_custkey") % 5).cast("int"))).alias("geometry")
    )


@query(
    """SELECT count(*) AS total, count(CASE WHEN event_type IN ('click', 'view') THEN 1 END) AS without_resource, count(CASE WHEN event_type NOT IN ('click', 'view') THEN 1 END) AS kept FROM events"""
)
def blank_resources(spark, sf_dir):
    """Rows without a resource go, and are counted on the way."""
    seen, at = Observation(), Q.folder(spark)
    resource = F.when(F.col("event_type") == "click", "").when(F.col("event_type") != "view", F.col("event_type"))
    rows = t(spark, sf_dir, "events").select("event_id", resource.alias("resource")).observe(
        seen, F.count("*").alias("total"), F.count_if(C.is_blank("resource")).alias("without_resource")
    )
    sinks.overwrite(joins.drop_blank(rows, "resource"), at)
    return spark.read.parquet(at).agg(
        F.lit(seen.get["total"]).alias("total"),
        F.lit(seen.get["without_resource"]).alias("without_resource"),
        F.count("*").alias("kept"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey % 3 = 1 THEN ' ' ELSE n_name END AS organisation FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_nationkey % 3 > 0"""
)
def blank_organisations(spark, sf_dir):
    nation = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    name = F.when(F.col("c_nationkey") % 3 == 1, " ").when(F.col("c_nationkey") % 6 == 3, "").when(
        F.col("c_nationkey") % 3 > 0, F.col("n_name")
    )
    return quality.drop_blank_organisations(
        t(spark, sf_dir, "customer").join(nation, "c_nationkey").select("c_custkey", name.alias("organisation"))
    )


LOCAL = """WITH owned AS (SELECT c_mktsegment || (o_orderkey % 101) AS dataset, o_orderkey AS entity, n_name AS organisation FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
lk AS (SELECT DISTINCT l_orderkey AS entity, CASE s_suppkey % 3 WHEN 0 THEN 'local-authority:' WHEN 1 THEN 'government-organisation:' ELSE 'development-corporation:' END || s_suppkey AS organisation FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
SELECT dataset, lk.organisation, 'some' AS seeder_quality, count(DISTINCT entity) AS seeder_entity_count FROM owned o JOIN lk USING (entity)
GROUP BY dataset, lk.organisation HAVING count(DISTINCT o.organisation) >= CASE WHEN lk.organisation LIKE 'government%' THEN 1 ELSE 2 END"""


@query(LOCAL)
def local_authorities(spark, sf_dir):
    """Who seeds entities of others, in datasets so small that the threshold for local authorities matters."""
    owned = Q._owned(spark, sf_dir).withColumns(
        {"dataset": F.concat("dataset", (F.col("entity") % 101).cast("string")), "quality": F.lit("some")}
    )
    kind = F.when(F.col("l_suppkey") % 3 == 0, "local-authority:").when(
        F.col("l_suppkey") % 3 == 1, "government-organisation:"
    ).otherwise("development-corporation:")
    lookup = t(spark, sf_dir, "lineitem").join(
        t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey"
    ).select(
        F.col("l_orderkey").alias("entity"), F.concat(kind, text("l_suppkey")).alias("organisation")
    )
    none = lookup.where("false").select(F.lit("").alias("dataset"), "organisation")
    return quality.seeder_side(owned, lookup, none, lookup.select("organisation").distinct())


# ------------------------------------------------------------------------------------------------- joins and dimensions


@query(
    """SELECT o_orderkey AS entity, CASE WHEN c_nationkey % 4 > 0 THEN c_nationkey::BIGINT END AS organisation_entity FROM orders JOIN customer ON c_custkey = o_custkey"""
)
def organisation_join(spark, sf_dir):
    """A code listed twice counts once; one not listed has no entity."""
    orders = t(spark, sf_dir, "orders").join(
        t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    ).select(F.col("o_orderkey").alias("entity"), F.concat(F.lit("n"), text("c_nationkey")).alias("organisation"))
    n = t(spark, sf_dir, "nation").where("n_nationkey % 4 > 0").select(
        F.concat(F.lit("n"), text("n_nationkey")).alias("organisation"),
        F.col("n_nationkey").cast("long").alias("entity"),
    )
    return history.join_organisation(
        orders, n.unionByName(n.withColumn("entity", F.col("entity") + 100))
    ).select("entity", "organisation_entity")


@query(
    """SELECT c_custkey AS entity, c_mktsegment AS dataset, CASE c_mktsegment WHEN 'BUILDING' THEN 'geography' WHEN 'MACHINERY' THEN 'value' WHEN 'AUTOMOBILE' THEN 'organisation' END AS typology FROM customer"""
)
def typology_lookup(spark, sf_dir):
    customers = t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("dataset")
    )
    named = F.create_map(
        *[F.lit(x) for x in ("BUILDING", "geography", "MACHINERY", "value", "AUTOMOBILE", "organisation")]
    )
    dimension = customers.select("dataset", named[F.col("dataset")].alias("typology")).where("typology IS NOT NULL")
    return history.join_typology(
        customers, dimension.unionByName(dimension.withColumn("typology", F.lit("zone")))
    ).select("entity", "dataset", "typology")


def _sources(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """source and resource lists: an endpoint per customer, open where the nation's region is 0, 1 or 2, delivering where it is 1."""
    rows = t(spark, sf_dir, "customer").join(t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    end = lambda open_: F.when(open_, "").otherwise("2020-01-01").alias("end-date")
    endpoint = F.concat(F.lit("e"), text("c_custkey"))
    source = rows.select(
        endpoint.alias("endpoint"),
        F.concat("c_mktsegment", F.lit(";"), "c_mktsegment").alias("pipelines"),
        F.col("n_name").alias("organisation"),
        end(F.col("n_regionkey") < 3),
    )
    return source, rows.select(
        F.concat(F.lit("r"), text("c_custkey")).alias("resource"),
        F.concat(endpoint, F.lit(";x"), text("c_custkey")).alias("endpoints"),
        end(F.col("n_regionkey") == 1),
    )


PROVIDERS = "SELECT DISTINCT c_mktsegment AS dataset, n_name AS organisation, n_regionkey = 1 AS has_active_resource FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey < 3"


@query(PROVIDERS)
def active_providers(spark, sf_dir):
    return pipelines.active_providers(*[C.snake_case(x) for x in _sources(spark, sf_dir)])


# ------------------------------------------------------------------------------------------------- schemas and upkeep


@query(
    """SELECT 'part' AS name, * FROM (VALUES ('done', 'add', 'notes', NULL, 'string'), ('pending', 'drop', 'p_size', 'int', NULL), ('pending', 'cast', 'p_partkey', 'string', 'bigint')) AS v(state, action, "column", before, after)"""
)
def migration_report(spark, sf_dir):
    at = f"{Q.folder(spark)}/part"
    t(spark, sf_dir, "part").select(text("p_partkey"), "p_name", F.col("p_size").cast("int")).write.parquet(at)
    found = S.migrate_all(spark, [(S.StructType.fromDDL("p_partkey bigint, p_name string, notes string"), at)])
    return S.report(spark, found).select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "state", "action", "column", "before", "after"
    )


@query("""SELECT o_orderkey, o_custkey, o_orderstatus FROM orders""")
def compact_partitions(spark, sf_dir):
    at = Q.folder(spark)
    t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    ).repartition(12).write.partitionBy("o_orderstatus").parquet(at)
    if sinks.compact(spark, [at])[at] != "compacted":
        raise ValueError("the table was not compacted")
    files = spark.read.parquet(at).select("o_orderstatus", F.col("_metadata.file_path").alias("f")).distinct().count()
    if files > 3:
        raise ValueError(f"{files} files are left")
    return spark.read.parquet(at)


# ------------------------------------------------------------------------------------------------- whole jobs


def _transformed(spark, sf_dir, at: str) -> None:
    """events as a dataset's collected values: a few have no resource, some come from resources that were withdrawn."""
    rows = t(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("entity"), F.col("event_type").alias("field"), F.concat(F.lit("v"), text("event_id")).alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("entry-date"),
        text("event_id").alias("entry-number"), (F.col("event_id") % 3).cast("string").alias("priority"), F.concat(F.lit("f"), (F.col("event_id") % 5000).cast("string")).alias("fact"),
        F.when(F.col("event_id") % 13 == 0, "").otherwise(F.concat(F.lit("r"), (F.col("event_id") % 97).cast("string"))).alias("resource"), F.lit("").alias("end-date"), F.lit("").alias("start-date"), F.lit("").alias("reference-entity"),
    )
    rows.write.parquet(at)


COLLECTED = "rows AS (SELECT user_id AS entity, event_type AS field, 'v' || event_id AS value, strftime(ts, '%Y-%m-%d') AS entry_date, event_id, event_id % 3 AS priority, 'f' || (event_id % 5000) AS fact, 'r' || (event_id % 97) AS resource FROM events WHERE event_id % 13 > 0 AND event_id % 97 % 10 > 0)"


def _load_entities(spark, sf_dir) -> tuple[str, dict]:
    at = Q.folder(spark)
    _transformed(spark, sf_dir, f"{at}/in")
    gone = t(spark, sf_dir, "events").select(
        F.concat(F.lit("r"), (F.col("event_id") % 97).cast("string")).alias("old_resource"),
        F.when(F.col("event_id") % 97 % 10 == 0, "410").otherwise("301").alias("status"),
    ).distinct()
    org = t(spark, sf_dir, "nation").select(
        F.col("n_name").alias("organisation"), F.col("n_nationkey").cast("long").alias("entity")
    )
    typology = t(spark, sf_dir, "events").select(
        F.lit("activity").alias("dataset"), F.lit("event").alias("typology")
    ).distinct()
    counts = pipelines.load_entities(
        spark, f"{at}/in", "activity", org, gone, f"{at}/out", typology, publish=f"{at}/published"
    )
    return at, counts


@query(
    f"""WITH {
        COLLECTED
    } SELECT 'activity' AS dataset, fact, field, priority::INT AS priority, entry_date, value, entity FROM rows QUALIFY row_number() OVER (PARTITION BY fact ORDER BY priority, entry_date, event_id) = 1"""
)
def fact_job(spark, sf_dir):
    at, _ = _load_entities(spark, sf_dir)
    return spark.read.parquet(f"{at}/out/fact").select(
        "dataset", "fact", "field", "priority", "entry_date", "value", "entity"
    )


@query(
    f"""WITH {
        COLLECTED
    } SELECT 'activity' AS dataset, fact, event_id::VARCHAR AS entry_number, priority::INT AS priority, entry_date, resource FROM rows"""
)
def fact_resource_job(spark, sf_dir):
    at, _ = _load_entities(spark, sf_dir)
    return spark.read.parquet(f"{at}/out/fact_resource").select(
        "dataset", "fact", "entry_number", "priority", "entry_date", "resource"
    )


ENTITIES = f"""{COLLECTED}, latest AS (SELECT * FROM rows QUALIFY row_number() OVER (PARTITION BY entity, field ORDER BY entry_date DESC, priority DESC, event_id DESC) = 1),
wide AS (SELECT entity, CASE max(priority) WHEN 1 THEN 'some' WHEN 2 THEN 'authoritative' ELSE '' END AS quality, {", ".join(f"max(CASE WHEN field = '{e}' THEN value END) AS {e}" for e in Q.EVENT_TYPES)} FROM latest GROUP BY entity)"""
FIELDS = "concat_ws(',', " + ", ".join(f"coalesce({e}, '-')" for e in Q.EVENT_TYPES) + ")"


@query(
    f"""WITH {
        ENTITIES
    } SELECT 'activity' AS dataset, entity, quality, 'event' AS typology, {FIELDS} AS fields FROM wide"""
)
def entity_job(spark, sf_dir):
    at, _ = _load_entities(spark, sf_dir)
    held = F.from_json("json", "map<string,string>")
    return spark.read.parquet(f"{at}/out/entity").select(
        "dataset",
        "entity",
        "quality",
        "typology",
        F.concat_ws(",", *[F.coalesce(held[e], F.lit("-")) for e in Q.EVENT_TYPES]).alias("fields"),
    )


@query(
    f"""WITH {
        ENTITIES
    } SELECT 'csv' AS kind, entity, quality FROM wide UNION ALL SELECT 'json', entity, quality FROM wide UNION ALL SELECT 'parquet', entity, quality FROM wide"""
)
def entity_job_published(spark, sf_dir):
    """The files that the job publishes, read again."""
    at, _ = _load_entities(spark, sf_dir)
    own = [F.col("entity").cast("long").alias("entity"), F.coalesce("quality", F.lit("")).alias("quality")]
    rows = spark.read.text([p for p in readers.discover(spark, f"{at}/published/activity.json*")])
    entities = F.coalesce(
        F.from_json("value", "struct<entities:array<map<string,string>>>")["entities"],
        F.array(F.from_json("value", "map<string,string>")),
    )
    as_json = rows.select(F.explode(entities).alias("e")).select(
        *[F.col("e")[c].alias(c) for c in ("entity", "quality")]
    ).where("entity IS NOT NULL")
    sides = {
        "csv": readers.csv(spark, f"{at}/published/activity.csv"),
        "json": as_json,
        "parquet": spark.read.parquet(f"{at}/published/activity.parquet"),
    }
    return joins.union_by_name(*[df.select(F.lit(k).alias("kind"), *own) for k, df in sides.items()])


@query(
    """SELECT event_id::VARCHAR AS entry_number, 'r' || (event_id % 97) AS resource, event_type AS field, 'activity' AS dataset, '' AS end_date, user_id AS entity FROM events WHERE event_id % 97 % 10 > 0 AND event_id % 11 > 0"""
)
def issue_job(spark, sf_dir):
    at = Q.folder(spark)
    resource = F.when(F.col("event_id") % 11 > 0, F.concat(F.lit("r"), (F.col("event_id") % 97).cast("string")))
    csv(
        t(spark, sf_dir, "events").select(
            F.col("event_id").alias("entry-number"),
            resource.alias("resource"),
            F.col("event_type").alias("field"),
            F.col("user_id").alias("entity"),
            F.lit("invalid").alias("issue-type"),
        ),
        f"{at}/in",
    )
    gone = t(spark, sf_dir, "events").where("event_id % 97 % 10 = 0").select(
        F.concat(F.lit("r"), (F.col("event_id") % 97).cast("string")).alias("old_resource"),
        F.lit("410").alias("status"),
    ).distinct()
    pipelines.load_table(spark, "issue", f"{at}/in", "activity", f"{at}/out", gone)
    return spark.read.parquet(f"{at}/out/issue").select(
        "entry_number", "resource", "field", "dataset", "end_date", "entity"
    )


@query(
    """SELECT 'r' || o_orderkey AS resource, o_custkey::INT AS entity_count, strftime(o_orderdate, '%Y-%m-%d') AS entry_date, 'order' AS dataset, NULL::INT AS line_count FROM orders"""
)
def dataset_resource_job(spark, sf_dir):
    at = Q.folder(spark)
    csv(
        t(spark, sf_dir, "orders").select(
            F.concat(F.lit("r"), text("o_orderkey")).alias("resource"),
            F.col("o_custkey").alias("entity-count"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("entry-date"),
            F.lit("many").alias("line-count"),
        ),
        f"{at}/in",
    )
    pipelines.load_table(spark, "dataset_resource", f"{at}/in", "order", f"{at}/out")
    return spark.read.parquet(f"{at}/out/dataset_resource").select(
        "resource", "entity_count", "entry_date", "dataset", "line_count"
    )


@query(
    """SELECT 'r' || l_orderkey AS resource, l_returnflag AS field, l_linestatus AS "column", 'line' AS dataset FROM lineitem"""
)
def column_field_job(spark, sf_dir):
    at = Q.folder(spark)
    csv(
        t(spark, sf_dir, "lineitem").select(
            F.concat(F.lit("r"), text("l_orderkey")).alias("resource"),
            F.col("l_returnflag").alias("field"),
            F.col("l_linestatus").alias("column"),
        ),
        f"{at}/in",
    )
    pipelines.load_table(spark, "column_field", f"{at}/in", "line", f"{at}/out")
    return spark.read.parquet(f"{at}/out/column_field").select("resource", "field", "column", "dataset")


LIVE = "dataset IN (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('FURNITURE', 'MACHINERY'))"


def _quality_job(spark, sf_dir) -> dict[str, DataFrame]:
    at = Q.folder(spark)
    source, resource = _sources(spark, sf_dir)
    sides = Q._sides(spark, sf_dir)
    for df, path in (
        (source, "own-collection/collection/source.csv"),
        (resource, "own-collection/collection/resource.csv"),
        (sides["lookup"], "config/pipeline/all/lookup.csv"),
    ):
        csv(df, f"{at}/base/{path}")
    organisation = sides["people"].select(
        "organisation",
        F.col("organisation_entity").alias("entity"),
        F.col("organisation_name").alias("name"),
        F.when(F.col("org_active"), "").otherwise("2020-01-01").alias("end_date"),
    )
    datasets = t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("dataset")).distinct()
    datasets = datasets.select(
        "dataset",
        F.when(F.col("dataset") == "MACHINERY", "staging").otherwise("production").alias("environment"),
        F.when(F.col("dataset") == "FURNITURE", "2020-01-01").otherwise("").alias("end_date"),
    )
    files = _entity_files(spark, sf_dir, f"{at}/entities")
    return pipelines.provision_quality(
        spark, f"{at}/base", organisation, sides["designated"], datasets, files, f"{at}/out"
    )


@query(f"WITH {Q.PROVISION} SELECT * FROM pq WHERE {LIVE}")
def quality_job(spark, sf_dir):
    return _quality_job(spark, sf_dir)["provision_quality"]


@query(f"""WITH {Q.PROVISION}, live AS (SELECT * FROM pq WHERE {LIVE} AND quality IS NOT NULL)
SELECT organisation, min(organisation_name) AS organisation_name, count(DISTINCT CASE WHEN quality = 'authoritative' THEN dataset END) AS authoritative_datasets, count(DISTINCT CASE WHEN quality = 'some' THEN dataset END) AS some_datasets,
count(DISTINCT dataset) AS total_datasets, sum(CASE WHEN owns_entities THEN entity_count ELSE 0 END)::BIGINT AS total_entities_owned, NULL::DOUBLE AS quality_score FROM live GROUP BY organisation ORDER BY lower(min(organisation_name)) NULLS FIRST""")
def quality_job_organisations(spark, sf_dir):
    return _quality_job(spark, sf_dir)["organisation_quality"]


@query(f"""WITH {Q.PROVISION}, live AS (SELECT * FROM pq WHERE {LIVE} AND quality IS NOT NULL), o AS (SELECT organisation, lower(min(organisation_name)) AS name FROM live GROUP BY organisation)
SELECT row_number() OVER (ORDER BY name NULLS FIRST) AS position, coalesce(name, '') AS name FROM o""")
def published_order(spark, sf_dir):
    """The report on organisations as published: its lines are in the order of their names."""
    at = Q.folder(spark)
    sinks.single_file(_quality_job(spark, sf_dir)["organisation_quality"].select("organisation_name"), f"{at}/out.csv")
    lines = spark.read.text(f"{at}/out.csv", wholetext=True).select(
        F.posexplode(F.split(F.regexp_replace("value", r"\n$", ""), "\n")).alias("position", "line")
    )
    plain = F.regexp_replace("line", '^"|"$', "")
    return lines.where("position > 0").select(F.col("position").cast("long").alias("position"), F.lower(plain).alias("name"))


@query(
    """SELECT p_partkey AS old_entity, 301 AS status, p_partkey + 1 AS entity, p_brand AS collection, 'd' || (p_partkey // 50) AS dataset FROM part WHERE p_partkey % 50 < 49 AND 'Brand#' || (p_partkey // 50 % 5 + 1) = left(p_brand, 7)"""
)
def old_entity_job(spark, sf_dir):
    """Redirects of all collections from their folders, for datasets of 50 entities each."""
    at = Q.folder(spark)
    rows = t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("old-entity"),
        F.lit("301").alias("status"),
        (F.col("p_partkey") + 1).alias("entity"),
        "p_brand",
    )
    sinks.file_per_value(rows, at, "p_brand", "{}/old-entity.csv")
    n = F.floor(F.col("p_partkey") / 50).cast("long")
    kinds = t(spark, sf_dir, "part").select(n.alias("n"), "p_brand").distinct().where(
        F.substring("p_brand", 1, 7) == F.concat(F.lit("Brand#"), (F.col("n") % 5 + 1).cast("string"))
    )
    spec = kinds.select(
        F.concat(F.lit("d"), text("n")).alias("dataset"),
        (F.col("n") * 50).alias("entity_minimum"),
        (F.col("n") * 50 + 49).alias("entity_maximum"),
        F.col("p_brand").alias("collection"),
    )
    return pipelines.load_old_entities(
        spark, f"{at}/*/old-entity.csv", spec, f"{at}-out"
    ).select("old_entity", "status", "entity", "collection", "dataset")


@query(Q.TASK_SQL)
def task_job(spark, sf_dir):
    """The task table from files of two collections: one holds logs and sources, the other issues."""
    at = Q.folder(spark)
    x = Q._task_inputs(spark, sf_dir)
    csv(C.kebab_case(x["log"]), f"{at}/a-collection/collection/log.csv")
    csv(C.kebab_case(x["source"]), f"{at}/a-collection/collection/source.csv")
    csv(C.kebab_case(x["issues"]), f"{at}/b-collection/issue/own/all.csv")
    return pipelines.generate_tasks(spark, at, x["types"], f"{at}-out", DAY)


@query(
    """SELECT 'n' || c_nationkey || '-' || (c_custkey // 25000) AS council_name, count(*) AS records FROM customer GROUP BY 1"""
)
def cadastral_study(spark, sf_dir):
    """Archives unpacked by executors, their features flattened to Parquet and counted."""
    at = Q.folder(spark)
    _, records = pipelines.cadastral_study(spark, Q._zipped(spark, sf_dir), at)
    return records


@query(
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS rings FROM customer WHERE c_custkey % 7 > 0"""
)
def valid_shapes(spark, sf_dir):
    """Shapes read back from GeoJSON lines keep their rings; those that are not valid are left out."""
    at = Q.folder(spark)
    names = t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    rows = Q.spread(Q._shapes(spark, sf_dir).join(names, "c_custkey")).withColumns(
        {
            "geometry": F.when(
                F.col("c_custkey") % 7 == 0, "POLYGON ((0 0, 1 1, 2 2, 0 0))"
            ).otherwise(F.col("geometry")),
            "point": F.lit(""),
        }
    )
    sinks.write_lines(sinks.feature_rows(rows.where(G.is_valid("geometry"))), at)
    held = nested.flatten_json(
        spark.read.text(at).select(
            F.get_json_object("value", "$.properties").alias("json"),
            F.get_json_object("value", "$.geometry.coordinates").alias("at"),
        ),
        keys=["c_custkey", "c_name"],
    )
    return held.select(
        F.col("c_custkey").cast("long"),
        "c_name",
        F.size(F.from_json("at", "array<array<array<double>>>")).alias("rings"),
    )
