"""Sources, sinks and whole jobs on a local folder."""

import io
import os
import time
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landloom.functions import nested
from landloom.plans import pipelines
from landloom.plans import schema as S
from landloom.sources import ranged, readers, sinks


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def test_files_are_read_by_their_own_header(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "extra,entity,quality\nx,1,some\n")
    put(f"{tmp_path}/b.csv", "quality,entity\nauthoritative,2\n")
    put(f"{tmp_path}/c.csv", "entity\n3\n")
    files = readers.discover(spark, f"{tmp_path}/*.csv")
    assert rows(readers.csv_by_name(spark, files, ["entity", "quality"])) == [("1", "some"), ("2", "authoritative")]
    assert rows(
        readers.csv_by_name(spark, files, ["entity"], {"dataset": readers.stem})
    ) == [("1", "a"), ("2", "b"), ("3", "c")]
    with pytest.raises(ValueError):
        readers.csv_by_name(spark, files, ["nothing"])


def test_tagged_by_folder(spark, tmp_path):
    put(f"{tmp_path}/x/old-entity.csv", "old-entity,status\n1,301\n")
    put(f"{tmp_path}/y/old-entity.csv", "old-entity,notes\n2,n\n")
    got = readers.tagged(spark, f"{tmp_path}/*/old-entity.csv", ["old_entity", "status", "notes"]).fillna("-")
    assert rows(got) == [("1", "301", "-", "x"), ("2", "-", "n", "y")]


def test_tags_of_long_paths(spark):
    """Each row's tag is read off the end of its path: found by search, the last of these took far longer."""
    paths = ["/a/b.x/c", "/a/.hid", "/a/b.", "/a/", "c.tar.gz", "", "/p/a%20b/c%2Bd+%41.csv", f"/{'a' * 50_000}/b/x.csv"]
    start = time.monotonic()
    got = spark.createDataFrame([(k, p) for k, p in enumerate(paths)], "k int, p string").select(
        "k", readers.stem("p").alias("stem"), readers.folder("p").alias("folder")
    )
    assert rows(got) == [
        (0, "c", "b.x"), (1, ".hid", "a"), (2, "b", "a"), (3, "", ""), (4, "c.tar", ""), (5, "", ""),
        (6, "c+d+A", "a b"), (7, "x", "b"),
    ]
    assert time.monotonic() - start < 15


def test_partition_replacement(spark, tmp_path):
    at = f"{tmp_path}/t"
    df = spark.createDataFrame([("ds-a", 1), ("ds-b", 2)], "dataset string, value long")
    for d in ("ds-a", "ds-b"):
        sinks.replace_partition(df, at, d)
    sinks.replace_partition(spark.createDataFrame([("ds-a", 9)], "dataset string, value long"), at, "ds-a")
    assert rows(spark.read.parquet(at), "dataset", "value") == [("ds-a", 9), ("ds-b", 2)]
    with pytest.raises(ValueError):
        sinks.replace_partition(df.withColumn("value", F.col("value").cast("string")), at, "ds-a")
    put(f"{at}/foreign.txt", "x")
    with pytest.raises(ValueError):
        sinks.replace_partition(df, at, "ds-a")


def test_migrate_and_compact(spark, tmp_path):
    at = f"{tmp_path}/t"
    spark.createDataFrame([(1, "2", "x")], "id int, n string, gone string").repartition(3).write.parquet(at)
    want = S.StructType.fromDDL("id int, n bigint, added string")
    d = S.diff(spark, want, at)
    assert (d.added, d.removed, d.changed) == ({"added": "string"}, {"gone": "string"}, {"n": ("string", "bigint")})
    S.migrate(spark, want, at)
    assert spark.read.parquet(at).columns == ["id", "n", "gone", "added"]
    S.migrate(spark, want, at, allow_destructive=True)
    assert spark.read.parquet(at).dtypes == [
        ("id", "int"), ("n", "bigint"), ("added", "string")
    ] and not S.diff(spark, want, at)
    out = sinks.compact(spark, [f"{tmp_path}/missing", at])
    assert out[at] == "compacted" and out[
        f"{tmp_path}/missing"
    ].startswith("failed") and spark.read.parquet(at).count() == 1
    assert not S.diff(spark, want, f"{tmp_path}/missing")


def test_published_files(spark, tmp_path):
    import json

    df = spark.createDataFrame(
        [("1", "POLYGON ((0 0, 1 0, 1 1, 0 0))", None), ("2", None, "POINT (1 2)"), ("3", None, None)],
        "entity string, geometry string, point string",
    )
    sinks.single_file(df, f"{tmp_path}/out.csv")
    assert open(f"{tmp_path}/out.csv").readline().strip() == "entity,geometry,point"
    sinks.publish_json(df, f"{tmp_path}/out.json")
    assert json.load(open(f"{tmp_path}/out.json"))["entities"][1] == {
        "entity": "2", "geometry": "", "point": "POINT (1 2)"
    }
    sinks.publish_geojson(df, f"{tmp_path}/out.geojson", "d")
    shapes = [f["geometry"] and f["geometry"]["type"] for f in json.load(open(f"{tmp_path}/out.geojson"))["features"]]
    assert shapes == ["Polygon", "Point", None]
    sinks.split_files(spark.range(2500), f"{tmp_path}/split", 1000)
    assert len([f for f in os.listdir(f"{tmp_path}/split") if f.endswith(".csv")]) >= 3


def test_documents_of_any_size_are_one_file(spark, tmp_path):
    import json

    for n, parts in ((0, 1), (1, 3), (200_000, 7)):
        df = spark.range(0, n, 1, parts).selectExpr(
            "concat('é\\n', id) AS entity", "concat('POINT (', id, ' 2)') AS point", "CAST(NULL AS STRING) AS geometry"
        )
        assert sinks.publish_json(df, f"{tmp_path}/out.json") == f"{tmp_path}/out.json"
        held = json.load(open(f"{tmp_path}/out.json"))["entities"]
        assert {e["entity"] for e in held} == {f"é\n{i}" for i in range(n)} and len(held) == n
        sinks.publish_geojson(df, f"{tmp_path}/out.geojson", 'a "name"')
        whole = json.load(open(f"{tmp_path}/out.geojson"))
        assert whole["name"] == 'a "name"' and len(whole["features"]) == n
        texts = [json.dumps(f, separators=(",", ":")) for f in whole["features"][:50]]
        assert texts == sorted(texts) or n > 1
    assert sorted(os.listdir(tmp_path)) == [".out.geojson.crc", ".out.json.crc", "out.geojson", "out.json"]


def test_large_tables_are_published_as_one_file(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "'x,\"y' AS v", "CAST(NULL AS STRING) AS `a.b`", "'' AS e")
    for rows in (10, 3_000_000):
        for fmt in ("csv", "parquet"):
            at = f"{tmp_path}/{rows}.{fmt}"
            sinks.publish_file(df, at, rows, fmt)
            assert os.path.isfile(at)
            back = spark.read.format(fmt).option("header", "true").load(at)
            assert back.columns == df.columns and back.where("v = 'x,\"y'").count() == 10


def test_a_file_for_each_value(spark, tmp_path):
    df = spark.createDataFrame([(i, f"k#{i % 3}+ä") for i in range(9)], "a int, k string")
    sinks.file_per_value(df, f"{tmp_path}/out", "k", "{}/own.csv")
    got = readers.tagged(spark, f"{tmp_path}/out/*/own.csv", ["a"])
    assert sorted((int(r.a), r.collection) for r in got.collect()) == [(i, f"k#{i % 3}+ä") for i in range(9)]


def test_quoted_headers_and_folders(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in/d.csv")
    for name, head in (("a.csv", '"x, y",b'), ("d.csv/part-0.csv", "b,other")):
        open(f"{tmp_path}/in/{name}", "w").write(f"{head}\n1,2\n")
    open(f"{tmp_path}/in/d.csv/_SUCCESS", "w").close()
    got = readers.csv_by_name(spark, readers.discover(spark, f"{tmp_path}/in/*.csv"), ["b"])
    assert sorted(r.b for r in got.collect()) == ["1", "2"] and readers.header(
        spark, f"{tmp_path}/in/a.csv"
    ) == ("x, y", "b")


def test_a_swap_that_fails_leaves_the_old_table(spark, tmp_path):
    at = f"{tmp_path}/t"
    spark.range(3).write.parquet(at)
    sinks.swap(spark.read.parquet(at).where("id > 0"), at)
    assert spark.read.parquet(at).count() == 2 and os.listdir(tmp_path) == ["t"]
    with pytest.raises(Exception, match="boom"):
        sinks.swap(spark.read.parquet(at).selectExpr("CAST(raise_error('boom') AS BIGINT) AS id"), at)
    assert spark.read.parquet(at).count() == 2


def test_compaction_of_partitions(spark, tmp_path):
    at = f"{tmp_path}/t"
    spark.range(1000).selectExpr("id", "id % 3 AS k").repartition(6).write.partitionBy("k").parquet(at)
    assert sinks.compact(spark, [at]) == {at: "compacted"}
    assert spark.read.parquet(at).count() == 1000 and all(
        len([f for f in os.listdir(f"{at}/k={k}") if f.endswith(".parquet")]) == 1 for k in range(3)
    )


def test_only_small_files_are_packed(spark, tmp_path):
    at = f"{tmp_path}/t"
    rows_ = spark.range(60_000).selectExpr("id", "id % 2 AS k", "'a b+c%' AS `j`", "sha2(string(id), 256) AS v")
    rows_.where("id < 50000").repartition(1).write.partitionBy("j", "k").parquet(at)
    rows_.where("id >= 50000").repartition(5).write.mode("append").partitionBy("j", "k").parquet(at)
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(at) for f in names if f.endswith(".parquet")}
    before = {f: os.stat(f).st_mtime_ns for f in files()}
    large = {f for f in before if os.path.getsize(f) > 500_000}
    assert len(large) == 2 and len(before) == 12
    assert sinks.compact(spark, [at], 1_000_000) == {at: "compacted"}
    after = files()
    assert len(after) == 4 and large < after and all(os.stat(f).st_mtime_ns == before[f] for f in large)
    key = ["id", "k", "j", "v"]
    assert spark.read.parquet(at).select(key).exceptAll(rows_.select(key)).count() == 0
    assert spark.read.parquet(at).count() == 60_000
    assert sinks.compact(spark, [at], 1_000_000) == {at: "compacted"} and files() == after


def test_bins():
    assert sinks.packed([("a", 60), ("b", 30), ("c", 25), ("d", 40), ("e", 49)], 100) == [["e", "d"], ["b", "c"]]
    assert sinks.packed([("a", 10)], 100) == [] == sinks.packed([], 100)


def test_headers_of_very_many_files(spark, tmp_path):
    for k in range(300):
        with open(f"{tmp_path}/f{k} +%.csv", "w", newline="") as out:
            out.write(("\ufeff" if k % 2 else "") + f"a,\"b {k % 3}\"\r\n" + "1,2\r\n" * 5)
    open(f"{tmp_path}/empty.csv", "w").close()
    found = ranged.headers(spark, readers.discover(spark, f"{tmp_path}/*.csv"))
    some = f"{tmp_path}/f1 +%.csv"
    assert ranged._names(ranged._first_line_by_hadoop(spark, some)) == ["a", "b 1"] == list(found[f"file:{some}"])
    assert ranged._first_line_by_hadoop(spark, f"{tmp_path}/empty.csv") == "" and not ranged.known("viewfs://store/x")
    assert len(found) == 301 and sorted(set(found.values())) == [(), *[("a", f"b {k}") for k in range(3)]]
    assert ranged.headers(spark, []) == {}


def test_archives_are_read_by_members(spark, tmp_path):
    doc = "<c>é " + "x" * 200_000 + "</c>"
    for name, method in (("one", zipfile.ZIP_DEFLATED), ("two", zipfile.ZIP_STORED)):
        with zipfile.ZipFile(f"{tmp_path}/{name}.zip", "w", method) as z:
            for k in range(70):
                z.writestr(f"deep/m{k}.GML", doc + str(k))
            z.writestr("readme.txt", "no")
    pattern = f"{tmp_path}/*.zip"
    sizes = readers.archive_members(spark, pattern, text=False)
    assert sizes.where("text IS NULL").count() == 140 and sizes.agg({"size": "min"}).first()[0] == len(doc.encode()) + 1
    got = {(r.archive, r.member): r.text for r in readers.archive_members(spark, pattern).collect()}
    assert got == {(a, f"{a}_m{k}.GML"): doc + str(k) for a in ("one", "two") for k in range(70)}
    assert readers.archive_members(spark, f"{tmp_path}/none*.zip").count() == 0


def test_rows_that_a_task_stages_again_count_once(spark):
    """A staging table with a task's rows twice, and with a part of another's: each part is left once."""
    url, jvm = "jdbc:derby:memory:again;create=true", spark.sparkContext._jvm
    rows_ = spark.range(100).selectExpr("id AS ID").repartition(4)
    for frame in (rows_, rows_.where("ID % 2 = 0"), rows_):
        sinks._with_attempt(frame).write.option("createTableColumnTypes", f"{sinks.TOKEN} VARCHAR(36)").jdbc(url, "STAGED", mode="append")
    link = jvm.java.sql.DriverManager.getConnection(url)
    sinks._drop_repeats(link, "STAGED", f'"{sinks.PART}"', f'"{sinks.TOKEN}"')
    link.close()
    left = spark.read.jdbc(url, "STAGED")
    assert left.count() == 100 == left.select("ID").distinct().count()


def test_features_of_documents_keep_their_own_names(spark, tmp_path):
    doc = """<?xml version="1.0"?><w:c xmlns:w="u" xmlns:g="v"><w:member><g:id k:l="1">5</g:id><note>a:b &amp; c</note></w:member>
<w:member><g:id>6</g:id></w:member></w:c>"""
    docs = spark.createDataFrame([("x", doc), ("y", None), ("z", "<c/>")], "council string, text string")
    rows = readers.features_of(docs)
    assert [(r.council, r.feature) for r in rows.collect()] == [
        ("x", '<member><id l="1">5</id><note>a:b &amp; c</note></member>'), ("x", "<member><id>6</id></member>")
    ]
    sinks.write_xml(rows.select(F.col("feature").alias("value")), f"{tmp_path}/xml")
    flat = nested.flatten_features(readers.xml_features(spark, f"{tmp_path}/xml"))
    assert sorted(map(str, (r.asDict() for r in flat.collect()))) == sorted(
        map(str, [{"id": "5", "id_l": "1", "note": "a:b & c"}, {"id": "6", "id_l": None, "note": None}])
    )


def test_relational_copy_is_tried_again_and_leaves_no_staging_table(spark, tmp_path, monkeypatch):
    url, left = f"jdbc:derby:{tmp_path}/db2;create=true", ["connection reset"]
    df = spark.createDataFrame([(1,), (2,)], "V long")
    df.write.jdbc(url, "T")
    own = sinks._jdbc_swap

    def flaky(*args):
        if left:
            raise RuntimeError(left.pop())
        return own(*args)

    monkeypatch.setattr(sinks, "_jdbc_swap", flaky)
    monkeypatch.setattr(sinks.time, "sleep", lambda s: None)
    assert sinks.jdbc_swap(df, url, "T") == 2 and not left
    with pytest.raises(Exception, match="boom"):
        sinks.jdbc_swap(df.selectExpr("CAST(raise_error('boom') AS BIGINT) AS V"), url, "T")
    held = spark.read.jdbc(url, "(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T') t")
    assert [r[0] for r in held.collect()] == ["T"]


def test_relational_copy(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    df = spark.createDataFrame([("a", 1), ("b", 2)], "DATASET string, VALUE_ long")
    df.coalesce(1).write.option("createTableColumnTypes", "DATASET VARCHAR(20)").jdbc(url, "T")
    new = spark.createDataFrame([(9, "a"), (8, "a")], "VALUE_ long, DATASET string")
    assert sinks.jdbc_swap(new, url, "T", "a", checked=True) == 2
    assert rows(spark.read.jdbc(url, "T")) == [("a", 8), ("a", 9), ("b", 2)]
    assert sinks.jdbc_swap(df, url, "T") == 2 and rows(spark.read.jdbc(url, "T")) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        sinks.jdbc_swap(df.limit(0), url, "T", checked=True)


@pytest.mark.parametrize("rows_,want", [(0, (1, 1000)), (250_000, (5, 3000)), (30_000_000, (20, 5000))])
def test_sizing(rows_, want):
    assert sinks.sizing(rows_) == want and sinks.file_partitions(3_000_000) == 3 and sinks.file_partitions(10**9) == 200


def test_entity_job(spark, tmp_path):
    eav = "entity string, field string, value string, `entry-date` string, `entry-number` string, priority string, `end-date` string, `start-date` string, fact string, `reference-entity` string, resource string"
    spark.createDataFrame(
        [
            ("1", "name", "A", "2024-01-01", "1", "2", "", "", "f1", "", "r1"),
            ("1", "name", "B", "2024-01-02", "1", "2", "", "", "f2", "", "gone"),
            ("1", "name", "C", "2024-01-02", "1", "2", "", "", "f3", "", ""),
        ],
        eav,
    ).write.parquet(f"{tmp_path}/in")
    org = spark.createDataFrame([("o", 1)], "organisation string, entity long")
    withdrawn = spark.createDataFrame([("gone", "410")], "old_resource string, status string")
    seen = pipelines.load_entities(
        spark, f"{tmp_path}/in", "d", org, withdrawn, f"{tmp_path}/out", publish=f"{tmp_path}/pub"
    )
    assert seen == {"rows": 2, "without_resource": 1}
    assert rows(spark.read.parquet(f"{tmp_path}/out/entity"), "name", "quality") == [("A", "authoritative")]
    assert sorted(
        f for f in os.listdir(f"{tmp_path}/pub") if not f.endswith(".crc")
    ) == ["d.csv", "d.geojson", "d.json", "d.parquet"]


def test_issue_job(spark, tmp_path):
    put(
        f"{tmp_path}/issue.csv",
        "entity,entry-number,field,issue-type,line-number,dataset,resource,value,message\n1,1,f,t,1,d,r,v,m\n2,1,f,t,1,d,,v,m\n",
    )
    pipelines.load_table(spark, "issue", f"{tmp_path}/issue.csv", "d", f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/issue").count() == 1


def test_task_job(spark, tmp_path):
    for c, n in (("a", "200"), ("b", "404")):
        put(
            f"{tmp_path}/{c}-collection/collection/log.csv",
            f"endpoint,resource,status,entry-date,exception\ne{c},{'r' + c if n == '200' else ''},{n},2024-01-01,\n",
        )
        put(
            f"{tmp_path}/{c}-collection/collection/source.csv",
            f"endpoint,pipelines,organisation,end-date\ne{c},d1;d2,o,\n",
        )
    put(f"{tmp_path}/a-collection/issue/d1/i.csv", "resource,dataset,field,issue-type\nra,d1,f,t\nra,d1,f,t\n")
    types = spark.createDataFrame(
        [("t", "error", "external")], "issue_type string, severity string, responsibility string"
    )
    out = pipelines.generate_tasks(spark, str(tmp_path), types, f"{tmp_path}/out", "2024-01-01")
    assert rows(out, "task_source", "dataset") == [("issue", "d1"), ("log", "d1"), ("log", "d2")]


def test_quality_job(spark, tmp_path):
    put(
        f"{tmp_path}/a-collection/collection/source.csv",
        "endpoint,pipelines,organisation,end-date\ne1,d,o1,\ne2,gone,o1,\n",
    )
    put(f"{tmp_path}/a-collection/collection/resource.csv", "resource,endpoints,end-date\nr,e1,\n")
    put(f"{tmp_path}/config/pipeline/a/lookup.csv", "entity,organisation\n1,o1\n")
    put(f"{tmp_path}/entity/d.csv", "entity,organisation-entity,quality\n1,7,authoritative\n")
    put(f"{tmp_path}/entity/skip.csv", "entity\n1\n")
    org = spark.createDataFrame(
        [("o1", 7, "One", "")], "organisation string, entity long, name string, end_date string"
    )
    live = spark.createDataFrame([("d", "production", "")], "dataset string, environment string, end_date string")
    none = spark.createDataFrame([], "dataset string, organisation string")
    out = pipelines.provision_quality(
        spark, str(tmp_path), org, none, live, readers.discover(spark, f"{tmp_path}/entity/*.csv"), f"{tmp_path}/out"
    )
    (r,) = out["provision_quality"].collect()
    assert (r.dataset, r.quality, r.entity_count, r.has_active_resource) == ("d", "authoritative", 1, True)
    assert os.path.exists(f"{tmp_path}/out/dataset_quality.csv")


def test_cadastral_study(spark, tmp_path):
    os.makedirs(f"{tmp_path}/zip")
    doc = '<c xmlns:g="urn:x">' + "".join(
        f'<g:featureMember>\n<P gid="{i}"><LABEL>L{i}</LABEL><TAG>a</TAG><TAG>b</TAG></P></g:featureMember>'
        for i in range(3)
    ) + "</c>"
    for name in ("leeds", "york"):
        with zipfile.ZipFile(f"{tmp_path}/zip/{name}.zip", "w") as z:
            z.writestr("x.gml", doc)
            z.writestr("readme.txt", "no")
    volume, counts = pipelines.cadastral_study(spark, f"{tmp_path}/zip/*.zip", f"{tmp_path}/work")
    assert rows(volume, "archive", "members", "bytes") == [("leeds", 1, len(doc)), ("york", 1, len(doc))]
    assert rows(counts) == [("leeds", 3), ("york", 3)]
    assert rows(spark.read.parquet(f"{tmp_path}/work/features"), "LABEL", "TAG", "P_gid")[0] == ("L0", "b", "0")


def test_members_of_an_archive_are_handed_on_together():
    """Members share batches: one for each made a task of a thousand members take seconds."""
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for k in range(500):
            z.writestr(f"{k}.gml", f"<a>{k}</a>")

    class Archives:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):  # noqa: N802
            return run

    batch = pa.RecordBatch.from_arrays([pa.array(["x/a.zip"]), pa.array([held.getvalue()])], ["path", "content"])
    (out,) = readers.members_of(Archives())([batch])
    assert out.num_rows == 500 and out.to_pylist()[7] == {"archive": "a", "member": "a_7.gml", "size": 8, "text": "<a>7</a>"}
