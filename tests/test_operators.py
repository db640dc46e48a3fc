"""Scenarios on a few rows each."""

import datetime

import random

import pytest
from pyspark.sql import functions as F

from landloom.functions import columns as C
from landloom.functions import nested
from landloom.operators import history, joins, quality, stats, tasks
from landloom.plans import schema as S


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


EAV = "entity string, field string, value string, entry_date string, entry_number string, priority string, end_date string, start_date string, fact string, reference_entity string, resource string"


@pytest.fixture
def transformed(spark):
    make = lambda f, v, n, p, r: ("1", f, v, "2024-01-01", n, p, "", "2024-01-01", f"f{n}", "", r)
    return spark.createDataFrame(
        [
            make("name", "A", "1", "2", "r1"),
            make("reference", "R", "2", "1", "r1"),
            make("organisation", "local-authority:ABC", "3", "1", "r1"),
            make("notes", "n", "4", "1", "r2"),
            make("geometry", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))", "5", "1", "r2"),
            make("entry-date", "2024-02-03", "6", "1", "r2"),
        ],
        EAV,
    )


def test_transformed_to_three_tables(spark, transformed):
    org = spark.createDataFrame(
        [("local-authority:ABC", 100), ("local-authority:ABC", 200)], "organisation string, entity long"
    )
    assert history.transform_fact_resource(transformed, "d").count() == 6
    assert history.transform_fact(transformed, "d").count() == 6
    (e,) = history.transform_entity(transformed, "d", org, "geography").collect()
    assert (
        e.dataset, e.entity, e.name, e.organisation_entity, e.quality, e.point, e.entry_date, e.typology
    ) == ("d", 1, "A", 100, "authoritative", "POINT (0.5 0.5)", datetime.date(2024, 2, 3), "geography")
    assert e.json == '{"notes":"n"}'


def test_entry_numbers_sort_as_numbers(spark):
    eav = spark.createDataFrame(
        [("1", "name", "old", "2024-01-01", "2"), ("1", "name", "new", "2024-01-01", "10")],
        "entity string, field string, value string, entry_date string, entry_number string",
    )
    assert rows(history.latest_values(eav), "value") == [("new",)]


@pytest.mark.parametrize("priority,label", [("1", "some"), ("2", "authoritative"), ("", ""), (None, ""), ("x", "")])
def test_quality_label(spark, priority, label):
    assert spark.createDataFrame([(priority,)], "p string").select(C.quality_of("p")).first()[0] == label


def test_no_priority_column_and_no_organisation_column(spark):
    eav = spark.createDataFrame(
        [("1", "point", "POINT (1 2)", "2024-01-01", "1"), ("1", None, "x", "2024-01-01", "2")],
        "entity string, field string, value string, entry_date string, entry_number string",
    )
    (e,) = history.transform_entity(eav, "d", spark.createDataFrame([], "organisation string, entity long")).collect()
    assert (e.quality, e.point, e.geometry, e.json) == ("", "POINT (1 2)", None, "{}")


def test_withdrawn_resources(spark):
    old = spark.createDataFrame([("a", "410"), ("b", "301"), (None, "410")], "old_resource string, status string")
    df = spark.createDataFrame([("a",), ("b",), (None,)], "resource string")
    assert joins.drop_withdrawn(df, old).select(
        F.coalesce("resource", F.lit("-"))
    ).collect() == [("b",), ("-",)] or rows(
        joins.drop_withdrawn(df, old).fillna("-")
    ) == [("-",), ("b",)]


def test_backfill(spark):
    df = spark.createDataFrame([("e1", ""), ("e2", "kept"), ("e3", None)], "endpoint string, dataset string")
    lookup = spark.createDataFrame([("e1", "a"), ("e1", "b"), ("e2", "z")], "endpoint string, dataset string")
    assert rows(joins.backfill(df, lookup, "endpoint", "dataset")) == [
        ("e1", "a"), ("e1", "b"), ("e2", "kept"), ("e3", "")
    ]


def test_typed_members_of_json(spark):
    docs = ['{"a":1,"b":{"c":[1,2],"d e":"x"},"VOID":true}', '{"a":2.5,"m":1,"n":null,"VOID":false}', '{"m":"t","b":{"c":[3]}}', None, "no json"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id long, json string")
    out = nested.flatten_typed(df)
    kinds = dict(out.dtypes)
    assert kinds["m"] == kinds["n"] == "string" and kinds["VOID"] == "boolean" and kinds["a"].startswith("decimal")
    assert kinds["b"] == "struct<c:array<bigint>,d e:string>"
    got = {r.id: r for r in out.collect()}
    assert float(got[1].a) == 2.5 and got[0].b.c == [1, 2] and got[0].b["d e"] == "x" and got[2].m == "t" and got[1].m == "1"
    assert got[3].a is None and got[4].b is None and len(got) == 5
    with pytest.raises(ValueError):
        nested.flatten_typed(df, most=2)
    with pytest.raises(ValueError):
        nested.flatten_json(df, most=2)
    assert nested.flatten_typed(df.limit(0)).columns == ["id"]


def test_sketches_merge(spark):
    df = spark.range(200_000).selectExpr("id % 50000 AS v", "id % 4 AS g", "id % 7 AS p")
    sketches = stats.distinct_sketches(df, ["g", "p"], "v")
    (n,) = stats.distinct_from(sketches, []).first()
    assert abs(n - 50_000) < 1000 and all(abs(r.distinct_values - 12_500) < 300 for r in stats.distinct_from(sketches, ["g"]).collect())


def test_ranges_of_any_width(spark):
    r, top = random.Random(2), (1 << 63) - 1
    ranges = [(0, -top - 1, top), (1, 5, 4), (2, 7, 7), (3, None, 9), (4, top, top), (5, -3, 1 << 62), (6, -top - 1, -top - 1), (7, 0, 1)]
    for k in range(60):
        low = r.randint(-(1 << 40), 1 << 40)
        ranges.append((10 + k, low, low + r.choice([0, 1, 2, 3, 7, 8, 9, 1000, 1 << 20, 10**12])))
    keys = [top, -top - 1, 0, 7, 7, None] + [x + d for _, a, b in ranges[8:] for x in (a, b) for d in (-1, 0, 1)]
    found = joins.range_join(
        spark.createDataFrame([(k,) for k in keys], "k long"),
        spark.createDataFrame(ranges, "id long, low long, high long"), "k", "low", "high",
    )
    want = [(k, i) for k in keys for i, a, b in ranges if k is not None and a is not None and a <= k <= b]
    assert found.columns == ["k", "id", "low", "high"] and sorted((x.k, x.id) for x in found.collect()) == sorted(want)
    assert joins.range_join(found.select("k"), found.limit(0).select("low", "high"), "k", "low", "high").count() == 0


def test_range_stats_equal_the_listed_pairs(spark):
    r = random.Random(4)
    keys = [r.randint(-300, 900) for _ in range(700)] + [None]
    ranges = [(k, a, a + r.choice([-1, 0, 1, 7, 64, 500, 10**12])) for k, a in enumerate(r.randint(-500, 1000) for _ in range(120))]
    ranges += [ranges[3], (500, None, 4), (501, -(10**15), 10**15)]
    found = joins.range_stats(
        spark.createDataFrame([(k,) for k in keys], "k long"),
        spark.createDataFrame(ranges, "id long, low long, high long"), "k", "low", "high",
    )
    own = [(i, [k for k in keys if k is not None and a <= k <= b]) for i, a, b in ranges if a is not None]
    assert sorted((x.id, x.n, x.first, x.total) for x in found.collect()) == sorted((i, len(v), min(v), sum(v)) for i, v in own if v)
    assert not joins.range_stats(found.select("low").limit(0), found.select("id", "high", "low"), "low", "low", "high").count()


def test_seeders_with_doubled_rows(spark):
    """Entities of several owners and rows that come twice count once; a null owner is none."""
    owned = spark.createDataFrame(
        [("d", 1, "a", "some"), ("d", 1, "b", "some"), ("d", 1, "a", "some"), ("d", 2, "a", "some"), ("d", 3, None, "some"), ("d", None, "c", "some"), ("d", 4, "a", "x")],
        "dataset string, entity long, organisation string, quality string",
    )
    pairs = [(1, "local-authority:p"), (1, "local-authority:p"), (2, "local-authority:q"), (2, "g"), (2, "g"), (1, "g"), (3, "h"), (2, "a"), (2, "off"), (4, "z"), (2, "named")]
    lookup = spark.createDataFrame(pairs, "entity long, organisation string")
    now = lookup.where("organisation != 'off'").select("organisation").distinct()
    named = spark.createDataFrame([("d", "named")], "dataset string, organisation string")
    out = quality.seeder_side(owned, lookup, named, now)
    assert sorted((r.organisation, r.seeder_entity_count) for r in out.collect()) == [("g", 2), ("local-authority:p", 1)]
    text = out._jdf.queryExecution().toString()
    assert "Expand" not in text  # rows are not doubled for two kinds of distinct counts


def test_old_entity(spark):
    spec = spark.createDataFrame(
        [("a", "c1", 4000, 4999), ("b", "c2", 11000, 11999)],
        "dataset string, collection string, entity_minimum long, entity_maximum long",
    )
    old = spark.createDataFrame(
        [
            ("4001", "301", "4002", "c1"),
            ("9", "301", "4002", "c1"),
            ("4003", "301", "4002", "c2"),
            ("4004", "301", "11001", "c1"),
            ("4005", "410", "", "c1"),
            ("x", "301", "4002", "c1"),
        ],
        ["old-entity", "status", "entity", "collection"],
    )
    assert rows(
        joins.transform_old_entity(old, spec).fillna({"entity": -1}), "old_entity", "entity", "dataset"
    ) == [(4001, 4002, "a"), (4005, -1, "a")]


def test_log_tasks_once_per_failure(spark):
    log = spark.createDataFrame(
        [
            ("d", "o", "e", None, "404", None, "2024-01-01"),
            ("d", "o", "e", None, "404", None, "2024-01-02"),
            ("d", "o", "e", None, "200", None, "2024-01-02"),
            ("d", "o", "e", None, None, None, "2024-01-02"),
        ],
        "dataset string, organisation string, endpoint string, resource string, status string, exception string, entry_date string",
    )
    (t,) = tasks.log_tasks(log, "2024-03-01").collect()
    assert (t.details, t.severity, len(t.reference)) == ('{"status":404,"exception":""}', "error", 16)


@pytest.mark.parametrize(
    "lists,want", [(["x;y"], [("x", 1), ("y", 1)]), (["x;x"], [("x", 1)]), (["x;y", "x"], [("x", 2), ("y", 1)])]
)
def test_issue_tasks_per_organisation(spark, lists, want):
    df = spark.createDataFrame(
        [("d", "r", "f", "t", "error", "external", o, "e") for o in lists],
        "dataset string, resource string, field string, issue_type string, severity string, responsibility string, organisation string, endpoint string",
    )
    got = tasks.issue_tasks(df, "2024-01-01").select(
        "organisation", F.get_json_object("details", "$.count").cast("int").alias("n")
    )
    assert rows(got) == want


def test_resource_of_two_endpoints_is_counted_once(spark):
    log = spark.createDataFrame(
        [("e1", "r", "200", "2024-01-01", None), ("e2", "r", "200", "2024-01-01", None)],
        "endpoint string, resource string, status string, entry_date string, exception string",
    )
    source = spark.createDataFrame(
        [("e1", "d", "o", ""), ("e2", "d", "o", None)],
        "endpoint string, pipelines string, organisation string, end_date string",
    )
    issues = spark.createDataFrame(
        [("r", "d", "f", "t")] * 2, "resource string, dataset string, field string, issue_type string"
    )
    types = spark.createDataFrame(
        [("t", "error", "external")], "issue_type string, severity string, responsibility string"
    )
    (t,) = tasks.all_tasks(log, source, issues, types, "2024-01-01").collect()
    assert '"count":2' in t.details and t.organisation == "o"


def test_active_resource_is_the_latest_success(spark):
    log = spark.createDataFrame(
        [
            ("a", "r1", "200", "2024-01-01"),
            ("a", "r2", "200", "2024-01-02"),
            ("a", "r3", "404", "2024-01-03"),
            ("b", "", "200", "2024-01-01"),
        ],
        "endpoint string, resource string, status string, entry_date string",
    )
    assert rows(tasks.active_resources(log, None)) == [("r2", "", "", "a")]


def test_quality_of_four_organisations(spark):
    people = spark.createDataFrame(
        [
            ("local-authority:A", 1, "A", True),
            ("local-authority:B", 2, "B", True),
            ("government:C", 3, "C", True),
            ("local-authority:D", 4, "D", True),
        ],
        "organisation string, organisation_entity long, organisation_name string, org_active boolean",
    )
    owned = spark.createDataFrame(
        [("d", 1, "authoritative", 10), ("d", 1, "some", 11), ("d", 2, "some", 12), ("d", 2, "", 13)],
        "dataset string, organisation_entity long, quality string, entity long",
    )
    providers = spark.createDataFrame(
        [("d", "local-authority:A", True), ("d", "local-authority:D", False)],
        "dataset string, organisation string, has_active_resource boolean",
    )
    lookup = spark.createDataFrame(
        [(11, "government:C"), (12, "government:C"), (12, "local-authority:D"), (12, "local-authority:A")],
        "entity long, organisation string",
    )
    designated = spark.createDataFrame(
        [("d", "local-authority:A"), ("d", "nobody")], "dataset string, organisation string"
    )
    pq = quality.provision_quality(providers, people, designated, lookup, owned)
    got = {r.organisation: r for r in pq.collect()}
    assert set(got) == {"local-authority:A", "local-authority:B", "government:C", "local-authority:D"}
    a, b, c, d = (got[k] for k in ("local-authority:A", "local-authority:B", "government:C", "local-authority:D"))
    assert (
        a.quality, a.entity_count, a.has_active_endpoint, a.is_designated_provider
    ) == ("authoritative", 2, True, True)
    assert (b.quality, b.entity_count, b.has_active_endpoint, b.owns_entities) == ("some", 2, False, True)
    assert (c.quality, c.entity_count, c.owns_entities) == ("some", 2, False)
    assert (d.quality, d.entity_count, d.has_active_endpoint, d.has_active_resource) == (None, 0, True, False)
    (dq,) = quality.dataset_quality(pq).collect()
    assert (
        dq.authoritative_organisations, dq.some_organisations, dq.total_organisations, dq.total_entities
    ) == (1, 2, 3, 4)
    assert {
        r.organisation: r.total_entities_owned for r in quality.organisation_quality(pq).collect()
    } == {"local-authority:A": 2, "local-authority:B": 2, "government:C": 0}


@pytest.mark.parametrize("env,want", [("production", ["p"]), ("staging", ["p", "s"]), ("development", ["d", "p", "s"])])
def test_live_datasets(spark, env, want):
    df = spark.createDataFrame(
        [
            ("p", "production", ""),
            ("s", "staging", None),
            ("d", "development", ""),
            ("n", "", ""),
            ("r", "production", "2020-01-01"),
        ],
        "dataset string, environment string, end_date string",
    )
    assert [x for (x,) in rows(quality.live_datasets(df, env))] == want


def test_blank_organisations(spark):
    assert quality.drop_blank_organisations(
        spark.createDataFrame([("d", ""), ("d", None), ("d", "o")], "dataset string, organisation string")
    ).count() == 1


def test_enforce(spark):
    df = spark.createDataFrame(
        [("1", "x", {"k": "v"}), ("n/a", "y", None)], "b string, extra string, m map<string,string>"
    )
    out = S.enforce(df, S.StructType.fromDDL("a string, b bigint, m string"))
    assert out.columns == ["a", "b", "m"] and [tuple(r) for r in out.collect()] == [
        (None, 1, '{"k":"v"}'), (None, None, None)
    ]


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-02",), ("",), ("soon",), (None,)], "d string")
    assert [r[0] for r in df.select(C.as_date("d")).collect()] == [datetime.date(2024, 1, 2), None, None, None]


def test_name_collision(spark):
    with pytest.raises(ValueError):
        C.snake_case(spark.createDataFrame([(1, 2)], ["a-b", "a_b"]))


def test_json_keys_of_all_rows(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":2,"b":"x"}'), (3, None)], "id int, json string")
    assert rows(nested.flatten_json(df).fillna("-")) == [(1, "1", "-"), (2, "2", "x"), (3, "-", "-")]


def test_summary_and_sizes(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    r = stats.summary(stats.records_per_group(df, "g"), "g").first()
    assert (r.groups, r.total, r.largest_group, r.smallest_group) == (2, 3, "a", "b")
    sizes = spark.createDataFrame([(500,), (2048,), (5 << 30,)], "n long").select(stats.readable_size("n")).collect()
    assert [s[0] for s in sizes] == ["500.00 B", "2.00 KB", "5.00 GB"]


def test_issue_without_resource_goes(spark):
    df = spark.createDataFrame([("1", "r"), ("2", None), ("3", "")], "entity string, resource string")
    assert rows(history.transform_issue(df, "d"), "entity", "dataset") == [(1, "d"), (3, "d")]


def test_order_and_partitioning_change_nothing(spark, transformed):
    org = spark.createDataFrame([("local-authority:ABC", 100)], "organisation string, entity long")
    want = history.transform_entity(transformed, "d", org).collect()
    assert history.transform_entity(transformed.orderBy(F.desc("fact")).repartition(7), "d", org).collect() == want
