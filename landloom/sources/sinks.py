"""Writing tables: partition replacement, whole-table swaps, single published files, relational copies, compaction.

File operations go through Hadoop's file system, so any store that Spark reaches will do."""

from __future__ import annotations

import json
import time
import uuid
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from landloom.functions import geometry as G


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at, _ = _fs(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at, _ = _fs(spark, path)
    fs.delete(at, True)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, bytes) of what lies directly in a folder, bytes summed over sub-folders."""
    fs, at, _ = _fs(spark, path)
    return [
        (s.getPath().getName(), fs.getContentSummary(s.getPath()).getLength()) for s in fs.listStatus(at)
    ] if fs.exists(at) else []


def _shape(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema}


def replace_partition(df: DataFrame, path: str, value: str, column: str = "dataset", fmt: str = "parquet") -> None:
    """Replace one value's partition and leave the others; refuse if the folder holds other files or has another schema.

    Parquet uses dynamic partition overwrite, which is atomic per task commit but not isolated from readers."""
    spark = df.sparkSession
    foreign = [n for n, _ in listing(spark, path) if not n.startswith((f"{column}=", "_", "."))]
    if foreign:
        raise ValueError(f"{path} holds files that are not partitions by {column}: {foreign[:3]}")
    if exists(spark, path) and listing(spark, path):
        there, here = _shape(spark.read.format(fmt).load(path)), _shape(df)
        if there.keys() != here.keys() or any(there[k] != here[k] for k in here if k != column):
            raise ValueError(f"schema of {path} differs: stored {there}, given {here}")
    df.where(F.col(column) == value).write.format(fmt).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(column).save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    df.write.format(fmt).mode("overwrite").options(**options).save(path)


def swap(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), fmt: str = "parquet") -> None:
    """Replace the table at path by df, which may read it: written beside it, then renamed. The old table is moved aside
    first and deleted last, so that one of the two is there whenever this stops."""
    spark, beside, aside = df.sparkSession, f"{
        path.rstrip('/')
    }-{uuid.uuid4().hex}", f"{path.rstrip('/')}-old-{uuid.uuid4().hex}"
    df.write.format(fmt).partitionBy(*partition_by).save(beside)
    fs, at, path_of = _fs(spark, path)
    had = fs.exists(at)
    if had and not fs.rename(at, path_of(aside)):
        raise OSError(f"{path} could not be moved aside; the new table is at {beside}")
    if not fs.rename(path_of(beside), at):
        if had:
            fs.rename(path_of(aside), at)
        raise OSError(f"{beside} could not be renamed to {path}")
    if had:
        fs.delete(path_of(aside), True)


def single_file(df: DataFrame, path: str, fmt: str = "csv", **options) -> None:
    """Publish a small result as one file; the temporary folder is removed."""
    spark, beside = df.sparkSession, f"{path}-{uuid.uuid4().hex}"
    df.coalesce(1).write.format(fmt).options(**({"header": "true"} | options if fmt == "csv" else options)).save(beside)
    fs, at, path_of = _fs(spark, path)
    part = next(s.getPath() for s in fs.listStatus(path_of(beside)) if s.getPath().getName().startswith("part-"))
    fs.delete(at, True)
    fs.mkdirs(at.getParent())
    fs.rename(part, at)
    fs.delete(path_of(beside), True)


def file_per_value(df: DataFrame, path: str, key: str, name: str = "{}.csv", fmt: str = "csv") -> None:
    """One file for each value of key, named after it; a value's rows are written by one task, all values in one job."""
    spark, beside = df.sparkSession, f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.repartition(key).write.format(fmt).options(
        **({"header": "true"} if fmt == "csv" else {})
    ).partitionBy(key).save(beside)
    fs, at, path_of = _fs(spark, path)
    for folder in fs.globStatus(path_of(f"{beside}/{key}=*")):
        value = unquote(folder.getPath().getName().split("=", 1)[1])
        part = next(s.getPath() for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("part-"))
        target = path_of(f"{path}/{name.format(value)}")
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        fs.rename(part, target)
    fs.delete(path_of(beside), True)


def _text(df: DataFrame, columns: list[str]) -> list:
    """Columns as JSON members: dates in ISO form, nulls as blanks."""
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]


def json_rows(df: DataFrame) -> DataFrame:
    """A JSON object per row as value."""
    return df.select(F.to_json(F.struct(*_text(df, df.columns))).alias("value"))


def feature_rows(df: DataFrame) -> DataFrame:
    """A GeoJSON feature per row as value: geometry, else point, and all else as properties."""
    rest = [c for c in df.columns if c not in ("geometry", "point")]
    shape = G.geojson(G.resolve("geometry", "point"))
    properties = F.to_json(F.struct(*_text(df, rest)))
    return df.select(
        F.concat(
            F.lit('{"type":"Feature","properties":'),
            properties,
            F.lit(',"geometry":'),
            F.coalesce(shape, F.lit("null")),
            F.lit("}"),
        ).alias("value")
    )


def write_lines(rows: DataFrame, path: str) -> None:
    """JSON lines, written by the executors."""
    rows.write.mode("overwrite").text(path)


def write_xml(rows: DataFrame, path: str, root: str = "c", namespaces: str = "") -> None:
    """rows(value) of XML elements as documents, one for each file, written by the executors."""

    def wrapped(frames):
        yield pd.DataFrame({"value": [f"<{root}{namespaces}>"]})
        yield from frames
        yield pd.DataFrame({"value": [f"</{root}>"]})

    write_lines(
        rows.select(F.regexp_replace("value", r"[\r\n]+", " ").alias("value")).mapInPandas(wrapped, "value string"),
        path,
    )


def joined_file(rows: DataFrame, path: str, begin: str = "", between: str = "\n", end: str = "\n") -> None:
    """rows(value) of text in one file of any size, with text before, between and after them.

    Executors write numbered parts, each row followed by between; the file system's client strings them together in
    that order, some kilobytes at a time. So no row and no task holds the file."""
    spark, beside = rows.sparkSession, f"{path}-{uuid.uuid4().hex}"
    rows.select("value").write.option("lineSep", between).text(f"{beside}/parts")
    fs, at, path_of = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    parts = [s for s in fs.listStatus(path_of(f"{beside}/parts")) if s.getPath().getName().startswith("part-")]
    parts = sorted((s for s in parts if s.getLen()), key=lambda s: s.getPath().getName())
    out = fs.create(path_of(f"{beside}/whole"))
    out.write(begin.encode())
    for k, s in enumerate(parts):
        last = len(between.encode()) if k == len(parts) - 1 else 0
        source = fs.open(s.getPath())
        bounded = jvm.org.apache.commons.io.input.BoundedInputStream(source, s.getLen() - last)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(bounded, out, 1 << 16, False)
        source.close()
    out.write(end.encode())
    out.close()
    fs.delete(at, True)
    fs.mkdirs(at.getParent())
    if not fs.rename(path_of(f"{beside}/whole"), at):
        raise OSError(f"{beside}/whole could not be renamed to {path}")
    fs.delete(path_of(beside), True)


def _publish(rows: DataFrame, path: str, begin: str, end: str) -> str:
    """value of all rows between begin and end in one file, in order of value. Returns where."""
    ordered = rows.repartitionByRange("value").sortWithinPartitions("value")
    joined_file(ordered, path, begin, ",", f"{end}\n")
    return path


def publish_json(df: DataFrame, path: str) -> str:
    """One {"entities":[...]} document of any size. Returns where."""
    return _publish(json_rows(df), path, '{"entities":[', "]}")


def publish_geojson(df: DataFrame, path: str, name: str) -> str:
    """One FeatureCollection of any size. Returns where."""
    return _publish(feature_rows(df), path, f'{{"type":"FeatureCollection","name":{json.dumps(name)},"features":[', "]}")


def sizing(rows: int, most: int = 20) -> tuple[int, int]:
    """(partitions, batch size) for a relational write: a task per 50,000 rows."""
    return max(1, min(most, rows // 50_000)), 1000 if rows < 100_000 else 3000 if rows < 1_000_000 else 5000


def file_partitions(rows: int) -> int:
    return max(1, min(200, rows // 1_000_000))


def publish_file(df: DataFrame, path: str, rows: int, fmt: str = "csv") -> None:
    """df, of so many rows, as one file of any size: text is written in parallel, as file_partitions() says, and strung
    together; Parquet goes through one writer, a row group at a time."""
    if fmt != "csv":
        return single_file(df, path, fmt)
    quoted = df.sparkSession.createDataFrame([tuple(df.columns)], [f"c{k}" for k in range(len(df.columns))])
    header = quoted.select(F.to_csv(F.struct("*")).alias("value")).first().value
    texts = df.select(F.to_csv(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{k}") for k, c in enumerate(df.columns)])).alias("value"))
    joined_file(texts.repartition(file_partitions(rows)), path, f"{header}\n")


def split_files(df: DataFrame, path: str, most: int = 500_000, fmt: str = "csv") -> None:
    """Files of at most so many records, 1000 at least."""
    df.write.format(fmt).mode("overwrite").option("header", "true").option(
        "maxRecordsPerFile", max(1000, most)
    ).save(path)


def convert(spark: SparkSession, source: str, path: str, key: str, fmt: str = "csv") -> None:
    """Parquet to delimited files, in a folder per value of key."""
    spark.read.parquet(source).write.partitionBy(key).mode("overwrite").option("header", "true").format(fmt).save(path)


def report(df: DataFrame, path: str) -> None:
    """A small result as CSV and Parquet, computed once."""
    held = df.persist()
    single_file(held, f"{path}.csv")
    single_file(held, f"{path}.parquet", "parquet")
    held.unpersist()


#: What a failure's text holds that may pass by itself.
TRANSIENT = ("connection", "timeout", "timed out", "deadlock", "too many clients")


def jdbc_swap(
    df: DataFrame,
    url: str,
    target: str,
    dataset: str | None = None,
    column: str = "dataset",
    checked: bool = False,
    properties: dict[str, str] | None = None,
    rows: int | None = None,
    types: str | None = None,
    tries: int = 3,
) -> int:
    """Append df to a staging table in parallel, then replace the rows of dataset (or all) in one transaction. Returns
    rows.

    df is computed once; rows that a task writes again, since it was tried again, count once. rows: how many are expected, for sizing(); types: column types of the staging table, as DDL.
    Columns go by position, so df is put into the target's order. checked: refuse an empty copy, and roll back if the
    rows inserted are not those staged. Failures that may pass are tried again; the staging table is dropped in any
    case."""
    for k in range(tries):
        try:
            return _jdbc_swap(df, url, target, dataset, column, checked, properties or {}, rows, types)
        except Exception as e:
            if k + 1 == tries or not any(x in str(e).lower() for x in TRANSIENT):
                raise
            time.sleep(2**k)
    raise ValueError("tries must be 1 or more")


#: Columns of a staging table: which part of the rows, and which attempt at it, a row comes from.
PART, TOKEN = "landloom_part", "landloom_attempt"


def _with_attempt(df: DataFrame) -> DataFrame:
    """df with PART and TOKEN. A task that is tried again, or twice at once, gives its rows another token."""
    schema = StructType([*df.schema, StructField(PART, IntegerType()), StructField(TOKEN, StringType())])

    def run(batches):
        part, token = TaskContext.get().partitionId(), str(uuid.uuid4())
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), pa.array([token] * n, pa.string())], schema.names
            )

    return df.mapInArrow(run, schema)


def _drop_repeats(link, staging: str, part: str, token: str) -> None:
    """Leave one complete attempt at each part: that with most rows, as a failed one has fewer, and a complete one has
    all. Only a row for each attempt comes to the driver."""
    found = link.createStatement().executeQuery(
        f"SELECT {part}, {token}, COUNT(*) FROM {staging} GROUP BY {part}, {token}"
    )
    attempts: dict[int, list[tuple[int, str]]] = {}
    while found.next():
        attempts.setdefault(found.getInt(1), []).append((found.getLong(3), found.getString(2)))
    found.close()
    for own in attempts.values():
        for _, other in sorted(own)[:-1]:
            gone = link.prepareStatement(f"DELETE FROM {staging} WHERE {token} = ?")
            gone.setString(1, other)
            gone.executeUpdate()


def _jdbc_swap(df, url, target, dataset, column, checked, properties, rows, types) -> int:
    spark, staging = df.sparkSession, f"{target}_staging_{uuid.uuid4().hex[:8]}"
    tasks, batch = sizing(rows) if rows is not None else (20, 3000)
    names = spark.read.jdbc(url, target, properties=properties).columns
    have = {c.lower(): c for c in df.columns}
    seen = Observation()
    ordered = df.select(*[F.col(have[c.lower()]).alias(c) for c in names]).observe(seen, F.count("*").alias("n"))
    ordered = ordered.repartition(tasks) if rows is not None else ordered.coalesce(tasks)
    ordered = _with_attempt(ordered)
    token = f"{TOKEN} VARCHAR(36)"
    jvm = spark.sparkContext._jvm
    info = jvm.java.util.Properties()
    for k, v in properties.items():
        info.setProperty(k, v)
    link = None
    try:
        out = ordered.write.option("batchsize", batch)
        kinds = f"{types}, {token}" if types else token
        out.option("createTableColumnTypes", kinds).jdbc(url, staging, mode="append", properties=properties)
        n = seen.get["n"]
        if checked and not n:
            raise ValueError(f"nothing to write to {target}")
        link = jvm.java.sql.DriverManager.getConnection(url, info)
        link.setAutoCommit(False)
        if dataset is None:
            link.createStatement().executeUpdate(f"DELETE FROM {target}")
        else:
            gone = link.prepareStatement(f"DELETE FROM {target} WHERE {column} = ?")
            gone.setString(1, dataset)
            gone.executeUpdate()
        quoted = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
        _drop_repeats(link, staging, quoted(PART), quoted(TOKEN))
        columns = ", ".join(quoted(c) for c in names)
        moved = link.createStatement().executeUpdate(f"INSERT INTO {target} SELECT {columns} FROM {staging}")
        if checked and moved != n:
            raise ValueError(f"{moved} of {n} rows were inserted into {target}")
        link.commit()
        return n
    except Exception:
        if link:
            link.rollback()
        raise
    finally:
        link = link or jvm.java.sql.DriverManager.getConnection(url, info)
        link.setAutoCommit(True)
        if link.getMetaData().getTables(
            None, None, staging.upper(), None
        ).next() or link.getMetaData().getTables(None, None, staging, None).next():
            link.createStatement().executeUpdate(f"DROP TABLE {staging}")
        link.close()


def jdbc_subdivided(df: DataFrame, url: str, target: str, dataset: str, geometry: str = "geometry", **options) -> int:
    """jdbc_swap() of geometry fragments of at most 256 vertices."""
    return jdbc_swap(G.subdivided(df, geometry=geometry), url, target, dataset, **options)


def packed(sizes: list[tuple[str, int]], target: int) -> list[list[str]]:
    """Bins of two files or more, of at most target bytes together, of those smaller than half of it: the largest first,
    each into the first bin with room."""
    bins: list[tuple[int, list[str]]] = []
    for path, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        if 2 * size >= target:
            continue
        at = next((k for k, (n, _) in enumerate(bins) if n + size <= target), None)
        if at is None:
            bins.append((size, [path]))
        else:
            bins[at] = bins[at][0] + size, [*bins[at][1], path]
    return [files for _, files in bins if len(files) > 1]


def _data_files(spark: SparkSession, path: str) -> dict[str, list[tuple[str, int]]]:
    """(path, bytes) of the data files in each folder of a table, at any depth."""
    fs, at, _ = _fs(spark, path)
    found: dict[str, list[tuple[str, int]]] = {}
    files = fs.listFiles(at, True)
    while files.hasNext():
        s = files.next()
        name, folder = s.getPath().toString(), s.getPath().getParent().toString()
        below = name.removeprefix(fs.makeQualified(at).toString()).split("/")
        if not any(x.startswith(("_", ".")) for x in below):
            found.setdefault(folder, []).append((name, s.getLen()))
    return found


def _compact(spark: SparkSession, path: str, target: int, fmt: str) -> None:
    fs, at, path_of = _fs(spark, path)
    if not fs.exists(at):
        raise FileNotFoundError(path)
    bins = [
        (folder, files) for folder, own in sorted(_data_files(spark, path).items()) for files in packed(own, target)
    ]
    if not bins:
        return
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    of = spark.createDataFrame(
        [(f, k) for k, (_, files) in enumerate(bins) for f in files], "_file string, _bin int"
    )
    whole = spark.read.format(fmt).load(path).schema
    inside = {part.split("=")[0] for folder, _ in bins for part in folder.split("/") if "=" in part}
    schema = type(whole)([f for f in whole if f.name not in inside])
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    held = spark.read.schema(schema).format(fmt).load([f for _, files in bins for f in files])
    # one task writes a bin; what it reads of each file is known by the file's path
    held = held.withColumn("_from", plain(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))))
    held = held.join(of.withColumn("_from", plain(F.col("_file"))), "_from").drop("_from", "_file")
    held.repartition(len(bins), "_bin").sortWithinPartitions("_bin").write.partitionBy("_bin").format(fmt).save(beside)
    for k, (folder, files) in enumerate(bins):
        new = [s.getPath() for s in fs.listStatus(path_of(f"{beside}/_bin={k}")) if not s.getPath().getName().startswith((".", "_"))]
        for f in files:  # hidden from readers first, so that a stop loses nothing
            old = path_of(f)
            fs.rename(old, path_of(f"{folder}/.old-{old.getName()}"))
        for f in new:
            fs.rename(f, path_of(f"{folder}/{f.getName()}"))
        for f in files:
            fs.delete(path_of(f"{folder}/.old-{path_of(f).getName()}"), False)
    fs.delete(path_of(beside), True)


def compact(spark: SparkSession, paths: list[str], target_bytes: int = 128 << 20, fmt: str = "parquet") -> dict[str, str]:
    """Pack the small files of each table, folder by folder at any depth, into files of at most about target_bytes; a
    failure is reported and the others go on.

    Only files below half of that are read and replaced, all bins in one job; others stay as they are. Replaced files are
    hidden under .old-* before the new one is moved in, and deleted last: after a stop in between, the folder holds
    either the new file or the hidden ones, or both. No other job may write to the table meanwhile."""
    out = {}
    for path in paths:
        try:
            _compact(spark, path, target_bytes, fmt)
            out[path] = "compacted"
        except Exception as e:  # noqa: BLE001
            out[path] = f"failed: {type(e).__name__}"
    return out
