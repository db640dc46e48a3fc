"""Reading collected files: delimited text by header, tagged folders, Parquet, XML features, archives."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from landloom.functions import columns as C
from landloom.operators.joins import union_by_name
from landloom.sources import ranged


def empty(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))


def discover(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob; none is no error."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(s.getPath().toString() for s in found or [])


def csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Delimited text with a header, all strings, names in snake case. For one layout; see csv_by_name for several."""
    return C.snake_case(spark.read.option("header", "true").options(**options).csv(path))


def csv_inferred(spark: SparkSession, path: str, header: bool = True, **options) -> DataFrame:
    return spark.read.csv(path, header=header, inferSchema=True, **options)


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names in the first line of a delimited file, or of the first file of a folder."""
    return ranged.headers(spark, [path])[path]


def _by_header(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header, in order of the first file of each."""
    found: dict[tuple[str, ...], list[str]] = {}
    heads = ranged.headers(spark, files)
    for f in sorted(files):
        found.setdefault(heads[f], []).append(f)
    return found


def csv_by_name(
    spark: SparkSession, files: list[str], columns: list[str], source: dict | None = None, missing: bool = False
) -> DataFrame:
    """The columns (snake case) of all files that have them, each by its own header: one scan per distinct header.

    missing: also take files that lack some, as nulls. source: further columns from the file, as {name: function of its
    path}. Fails if no file can be used."""
    frames = []
    for head, own in _by_header(spark, files).items():
        names = [h.replace("-", "_") for h in head]
        if not missing and not set(columns) <= set(names):
            continue
        schema = StructType([StructField(n, StringType()) for n in names])
        df = spark.read.schema(schema).option("header", "true").csv(own)
        picked = [F.col(c) if c in names else F.lit(None).cast("string").alias(c) for c in columns]
        frames.append(
            df.select(*picked, *[f(F.col("_metadata.file_path")).alias(n) for n, f in (source or {}).items()])
        )
    if not frames:
        raise ValueError(f"none of {len(files)} files has the columns {columns}")
    return union_by_name(*frames)


def _named(part):
    """A part of a path as it is on disk: _metadata.file_path is a URI."""
    decoded = F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(part, F.lit("%")), decoded).otherwise(part)


# Both are worked out for each row, so that patterns see the end of a path alone, and from its start: searched for in
# whole paths they take time in the square of their length.


def stem(path):
    """The name of a file without folder and extension."""
    return _named(F.regexp_extract(F.substring_index(path, "/", -1), r"^([^/]+?)(?:\.[^./]*)?$", 1))


def folder(path, up: int = 1):
    """The name of the folder a file is in, or of one further up."""
    return _named(F.regexp_extract(F.substring_index(path, "/", -1 - up), r"^([^/]+)(?:/[^/]+){%d}$" % up, 1))


def entity_quality(spark: SparkSession, files: list[str]) -> DataFrame:
    """(dataset, entity, organisation_entity, quality) from a file per dataset; files without those columns are left
    out."""
    return csv_by_name(spark, files, ["entity", "organisation_entity", "quality"], {"dataset": stem})


def tagged(spark: SparkSession, pattern: str, columns: list[str], tag: str = "collection", up: int = 1) -> DataFrame:
    """All files of a pattern, tagged with a folder's name; columns that a file lacks are null."""
    return csv_by_name(spark, discover(spark, pattern), columns, {tag: lambda p: folder(p, up)}, missing=True)


def old_resources(spark: SparkSession, path: str) -> DataFrame:
    return csv(spark, path).select("old_resource", "status", "resource")


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_or_empty(spark: SparkSession, path: str, columns: list[str], fmt: str = "parquet") -> DataFrame:
    from landloom.sources.sinks import exists

    return spark.read.format(fmt).load(path) if exists(spark, path) else empty(spark, columns)


def xml_features(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Features of cadastral XML: featureMember elements, else member elements, without namespaces. A file is one
    document: what follows the end of its root element is not read (see features_of() for documents in a column)."""
    for tag in ("featureMember", "member"):
        df = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true").option(
            "attributePrefix", "_attr_"
        ).load(path)
        if df.columns:
            return df
    return df


def features_of(documents: DataFrame, text: str = "text") -> DataFrame:
    """A row per feature (as in xml_features()) of each row's XML document, as feature: its text without namespaces."""
    tag = r"(?:[\w.-]+:)?(?:featureMember|member)"
    found = F.regexp_extract_all(text, F.lit(rf"(?s)(<{tag}\b[^>]*>.*?</{tag}\s*>)"), F.lit(1))
    rows = documents.select(*[c for c in documents.columns if c != text], F.explode(found).alias("feature"))
    plain = F.regexp_replace("feature", r"\sxmlns(?::[\w.-]+)?\s*=\s*(?:\"[^\"]*\"|'[^']*')", "")
    plain = F.regexp_replace(
        F.regexp_replace(plain, r"(</?)[\w.-]+:", "$1"), r"(\s)[\w.-]+:([\w.-]+\s*=\s*[\"'])", "$1$2"
    )
    return rows.withColumn("feature", plain)


def archive_members(spark: SparkSession, pattern: str, suffix: str = ".gml", text: bool = True) -> DataFrame:
    """(archive, member, size, text) of the members of zip archives that match a pattern, of any size. Without text only
    the archives' directories are read. Archives in a store for which Arrow has no file system are read whole, and may
    have 2 GB at most."""
    paths = discover(spark, pattern)
    if paths and not ranged.known(paths[0]):
        return members_of(spark.read.format("binaryFile").load(pattern), suffix, text)
    entries = ranged.archive_entries(spark, paths, suffix)
    if text:
        return ranged.member_texts(entries)
    return entries.select("archive", "member", "size", F.lit(None).cast("string").alias("text"))


def members_of(archives: DataFrame, suffix: str = ".gml", text: bool = True) -> DataFrame:
    """(archive, member, size, text) of the members of zip archives(path, content); executors unzip, a member at a time,
    and hand on several together. text: also their contents."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                name = path.as_py().rsplit("/", 1)[-1].rsplit(".", 1)[0]
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    for m in z.infolist():
                        if m.filename.lower().endswith(suffix):
                            own = z.read(m).decode("utf-8", "replace") if text else None
                            held.append((name, f"{name}_{m.filename.rsplit('/', 1)[-1]}", m.file_size, own))
                            size += 200 + len(own or "")
                            if size > ranged.BATCH:
                                yield ranged.member_batch(held)
                                held, size = [], 0
        if held:
            yield ranged.member_batch(held)

    return archives.select("path", "content").mapInArrow(run, ranged.MEMBERS)
