"""What the corpus operators share: saved intermediates, word tables over Arrow batches, rolling hashes, winnowing.

The vectorised helpers work on blocks of a few megabytes, so a task's memory doesn't depend on its partition's size;
a document longer than a block gets a block of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 19
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; one of its own only where that is unset and Spark
    runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="landloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def save(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/landloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._saved_at = path
    return back


def forget(*frames: DataFrame) -> None:
    """Delete saved tables that nothing reads any more."""
    for df in frames:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(df._saved_at)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------------------------------------- Arrow and bytes


def blocks(
    batches: Iterator[pa.RecordBatch], column: str, field: str | None = None, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a column of strings (or a field of a column of structs) has at most limit bytes in each, or
    one row."""
    for batch in batches:
        strings = batch.column(column) if field is None else batch.column(column).field(field)
        sizes = np.cumsum(pc.fill_null(pc.binary_length(strings), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + limit, "right")))
            yield batch.slice(start, end - start)
            start = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of strings, and where each row's begin (one more at the end); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes: every bit depends on every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: A random 64-bit value for each byte, from a counter.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(
        np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)]).cumprod(dtype=np.uint64)
        for b in (np.uint64(BASE), np.uint64(INVERSE))
    )


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(16, int(n).bit_length()))
    return up[:n], down[:n]


def prefixes(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times powers of a base, for spans()."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], dtype=np.uint64, out=out[1:])
    return out


def spans(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end], equal for equal contents wherever they stand."""
    return mixed((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts] + (ends - starts).astype(np.uint64))


def windows(prefix: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of size values, crossing documents too (see inside())."""
    n = len(prefix) - size
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mixed((prefix[size:] - prefix[:-size]) * powers(n)[1] + np.uint64(size))


def inside(offsets: np.ndarray, size: int, n: int) -> np.ndarray:
    """Of the n run starts, which have all their size values in one document; offsets: where documents begin."""
    ok = np.zeros(max(0, n), bool)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= size:
            ok[a : b - size + 1] = True
    return ok


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes, and at which word each document begins (one more at the end).

    UTF-8 keeps bytes of 0x80 and more for other than ASCII, so words split at ASCII bytes are the same as in code
    points."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~gaps[data]
    fresh = np.empty(len(data) + 1, bool)
    fresh[0] = fresh[-1] = True
    fresh[1:-1] = ~word[:-1]
    fresh[offsets] = True
    starts = np.flatnonzero(word & fresh[:-1])
    last = np.empty(len(data) + 1, bool)
    last[-1] = True
    last[:-1] = ~word
    last[offsets] = True
    ends = np.flatnonzero(word & last[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_table(column: pa.Array, lower: bool = False, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and at which word each document begins."""
    data, offsets = utf8(column)
    if lower:
        data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, gaps)
    return spans(prefixes(BYTE_VALUES[data]), starts, ends), first


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i+w]) for each i, in linear time, from running minima of blocks of w in both directions."""
    n = len(x)
    if n < w:
        return x[:0]
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    cut = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(cut, axis=1).ravel()
    behind = np.minimum.accumulate(cut[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def winnow(grams: np.ndarray, w: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least gram of each window of w grams, 0 where valid is false; which positions some valid window selects).

    Equal windows select equal grams at equal places, so each shared window shares an anchor."""
    least = np.where(valid, sliding_min(grams, w), np.uint64(0))
    padded = np.zeros(len(least) + 2 * (w - 1), np.uint64)
    padded[w - 1 : w - 1 + len(least)] = least
    most = ~sliding_min(~padded, w)
    return least, np.flatnonzero((most[: len(grams)] == grams) & (grams != 0))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in at least one of the intervals."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def annotate(docs: DataFrame, text: str, fields: str, make) -> DataFrame:
    """(row, *fields): every row of docs as a struct, with what make(column of texts) gives for it as a dict of
    arrays."""
    from pyspark.sql.types import StructType

    plain = docs.select(F.struct("*").alias("row"))
    schema = StructType([plain.schema["row"], *StructType.fromDDL(fields)])
    names = schema.names

    def run(batches):
        for part in blocks(batches, "row", text):
            made = make(part.column("row").field(text))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    *[made[x] if isinstance(made[x], pa.Array) else pa.array(made[x]) for x in names[1:]],
                ],
                names,
            )

    return plain.mapInArrow(run, schema)


def unpack(docs: DataFrame, columns: list[str]) -> list:
    """Columns of the struct row."""
    return [F.col("row").getField(c).alias(c) for c in columns]


# ------------------------------------------------------------------------------------------------- columns


UPPER_ASCII, LOWER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c):
    """Lower-case A-Z only; the fast built-in is the same thing where all bytes are ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER_ASCII, LOWER_ASCII))


# ------------------------------------------------------------------------------------------------- hot keys


#: A key is hot if more than one in PARTS of the rows have it, and more than LEAST. So at most PARTS keys are, whatever
#: the number of rows, and they may be broadcast. Where that would leave more than MOST rows to one task, keys of more
#: than MOST rows are hot, unless these are more than FEW.
PARTS, LEAST, MOST, FEW = 4096, 1000, 1 << 20, 1 << 17


def hot_keys(counts: DataFrame, n: str = "n") -> tuple[DataFrame | None, int]:
    """(hot keys or None, limit) of counts: a row per key with the number n of rows that have it. counts is read two or
    three times."""
    total, most = counts.agg(F.sum(n), F.max(n)).first()
    limit = max(LEAST, (total or 0) // PARTS)
    if limit > MOST and (most or 0) > MOST and counts.where(F.col(n) > MOST).count() <= FEW:
        limit = MOST
    return (counts.where(F.col(n) > limit) if (most or 0) > limit else None), limit


def look_up(rows: DataFrame, counts: DataFrame, on: list[str], by: list[str], n: str = "n") -> DataFrame:
    """Inner join of rows with counts, which has a row per key and the number n of rows that have it; on[0] is a long.

    Rows of hot keys get theirs from a broadcast, and are dealt by a hash of the columns by where the others are joined,
    instead of meeting in one task."""
    hot, limit = hot_keys(counts, n)
    if hot is None:
        return rows.join(counts, on)
    rest = [c for c in counts.columns if c not in on]
    own = F.struct(*rest)
    keyed = rows.join(F.broadcast(hot.select(*on, own.alias("_hot"))), on, "left")
    keyed = keyed.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(on[0])).otherwise(F.xxhash64(*by)))
    cold = counts.where(F.col(n) <= limit).select(
        F.col(on[0]).alias("_cold_key"), *[F.col(c).alias(f"_cold_{c}") for c in on[1:]], own.alias("_cold")
    )
    same = (F.col("_key") == F.col("_cold_key")) & F.col("_hot").isNull()
    for c in on[1:]:
        same = same & (F.col(c) == F.col(f"_cold_{c}"))
    found = F.coalesce("_hot", "_cold").alias("_found")
    joined = keyed.join(cold, same, "left").select(*rows.columns, found).where("_found IS NOT NULL")
    return joined.select(*rows.columns, *[F.col("_found").getField(c).alias(c) for c in rest])


def even_join(left: DataFrame, right: DataFrame, on: str, by: list[str], counts: DataFrame, n: str = "n") -> DataFrame:
    """Inner join of left with right, which has a row or a few per key; counts: the number n of left's rows per key.

    Left's rows of a hot key are dealt over shares by a hash of the columns by, and right's are repeated for each share;
    there are few shares of hot keys: at most 2 * PARTS, or one for each MOST rows."""
    hot, limit = hot_keys(counts, n)
    if hot is None:
        return left.join(right, on)
    shares = F.broadcast(hot.select(on, F.ceil(F.col(n) / F.lit(limit)).cast("int").alias("_shares")))
    one = left.join(shares, on, "left").withColumn(
        "_share", F.coalesce(F.pmod(F.xxhash64(*by), "_shares").cast("int"), F.lit(0))
    ).drop("_shares")
    other = right.join(shares, on, "left").withColumn(
        "_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1))
    ).drop("_shares")
    return one.join(other, [on, "_share"]).drop("_share")


# ------------------------------------------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as (a, b) pairs of ids; component: the smallest id reachable.

    Alternates large-star and small-star steps: each links a node's neighbours to its least one, the first those that
    are larger, the second those that are smaller. A step is one aggregation by node and one join, by look_up() where
    there are many edges, so a node with very many neighbours is no single task's group. Steps are saved and report
    whether they changed anything; a graph of stars is recognised in one round."""
    few = 4 * edges.sparkSession.sparkContext.defaultParallelism  # ids only: tasks beyond four a core are overhead
    plain = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = save(plain.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).coalesce(few))
    many = now.count() > 1 << 16

    def joined(rows: DataFrame, counts: DataFrame, on: str, by: str) -> DataFrame:
        return look_up(rows, save(counts), [on], [by]).drop("n") if many else rows.join(counts.drop("n"), on)

    while True:
        least = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(
            F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n")
        )
        seen = Observation()
        large = joined(now, least.withColumnRenamed("a", "b"), "b", "a").observe(
            seen, F.count_if(F.col("m") < F.col("b")).alias("n")
        )
        large = save(large.select("a", F.col("m").alias("b")).coalesce(few))
        more = Observation()
        small = save(
            large.groupBy("a").agg(
                F.min("b").alias("b"), F.max("b").alias("last"), F.count("*").alias("n")
            ).observe(more, F.count_if(F.col("b") < F.col("last")).alias("n")).coalesce(few)
        )
        changed, several = (seen.get["n"] or 0) + (more.get["n"] or 0), more.get["n"]
        forget(now)
        now = small.select("a", "b")
        if several:
            others = joined(
                large, small.where("b < last").select("a", F.col("b").alias("m"), "n"), "a", "b"
            ).where("b > m")
            now = save(now.unionByName(others.select(F.col("b").alias("a"), F.col("m").alias("b"))))
            forget(small)
        else:
            now._saved_at = small._saved_at
        forget(large)
        if not changed:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
