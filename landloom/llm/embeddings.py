"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

Rotations are learnt on a bounded sample so that the signs of the rotated vectors are balanced codes that keep angles.
Vectors that share a direction are centred on the sample's mean first, else most bits would be the same for all; that
widens the angles of near pairs, so it takes more bits. Whether to centre, how many bits a table has and how many tables
there are is chosen by the angles measured in the sample, as the cheapest layout by which two vectors at the threshold
agree in all bits of at least one table with a chance of RECALL, whatever the number of vectors. The tables stand for
random ones over learnt bits: it is not a pigeonhole over one code. Vectors of one bucket of a table are candidates, and
candidates are reranked by the cosine of the original vectors in double precision, each pair in the first table in which
it meets.

Codes are dealt to tables first, without vectors; vectors then follow to the buckets that hold several. Pairs never
leave a task: a task returns, per vector, how many others it links with and the smallest id it is connected with there.
A bucket with very many vectors is dealt over blocks and pairs of blocks. Equal vectors are one from the start."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.common import components, forget, save, table

SAMPLE = 20_000
#: The chance that two vectors meet whose cosine is just the threshold; closer ones meet with more.
RECALL = 0.99
#: Bits that a table may have, the most tables, and what a vector in a table costs, in comparisons of two vectors.
LENGTHS, TABLES, ROW = range(8, 32), 1024, 64
#: So many buckets of more than a block are broadcast at most (some 30 MB); beyond, a shuffled join marks them.
MAX_HOT = 1 << 20


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Angles between the rows of a and of b, as parts of a half turn; a right angle where a row is zero."""
    size = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
    cosine = np.divide(np.einsum("ij,ij->i", a, b), size, out=np.zeros(len(a)), where=size > 0)
    return np.arccos(np.clip(cosine, -1, 1)) / np.pi


def layout(n: int, x: np.ndarray, least: float, recall: float = RECALL) -> tuple[int, int, np.ndarray]:
    """(tables, bits of each, what to centre on) for n vectors, of which x is a sample of unit rows. A bit differs with
    the chance of the angle over pi, vectors meet in a table if none does."""
    random = np.random.default_rng(7)
    a = x[random.integers(0, len(x), 2000)]
    aside = random.normal(size=a.shape)
    aside -= np.einsum("ij,ij->i", a, aside)[:, None] * a
    size = np.linalg.norm(aside, axis=1, keepdims=True)
    aside = np.divide(aside, size, out=np.zeros_like(aside), where=size > 1e-9)
    near = least * a + math.sqrt(max(0.0, 1 - least * least)) * aside
    i, j = random.integers(0, len(x), (2, 20_000))
    i, j = i[i != j], j[i != j]
    best = None
    for shift in (np.zeros(x.shape[1]), x.mean(0)):
        close, far = angles(a - shift, near - shift), angles(x[i] - shift, x[j] - shift)
        for length in LENGTHS:
            meet = (1 - close) ** length
            low, high = 1, TABLES
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if 1 - np.mean((1 - meet) ** middle) >= recall else (middle + 1, high)
            if low == TABLES and length > LENGTHS[0]:
                break  # more bits would miss more
            load = low * (ROW + n * (np.mean((1 - far) ** length) if len(far) else 0.5**length))
            if best is None or load < best[0]:
                best = load, low, length, shift
    return best[1:]


def hyperplanes(x: np.ndarray, tables: int, length: int) -> np.ndarray:
    """A matrix whose product's signs are the bits of all tables, those of one table side by side: rotations learnt from
    different starts, as many as have the columns wanted."""
    turns = [learn_rotation(x, k + 1) for k in range(math.ceil(tables * length / x.shape[1]))]
    return np.concatenate(turns, 1)[:, : tables * length]


def learn_rotation(x: np.ndarray, start: int, rounds: int = 40) -> np.ndarray:
    """A rotation that brings the vectors x close to the corners of a cube, from a random start."""
    turn = np.linalg.qr(np.random.default_rng(start).normal(size=(x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(x @ turn >= 0, 1.0, -1.0).T @ x)
        turn = (u @ w).T
    return turn


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that neither very large nor very small components overflow when squared."""
    x = x / np.abs(x).max(1, keepdims=True) if len(x) else x
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centred(x: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Rows that differ from shift, seen from it, at length one."""
    x = x - shift
    return unit(x[np.abs(x).max(1) > 1e-12]) if len(x) else x


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return unit(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))


def encode(vectors: DataFrame, dim: int, rotation: np.ndarray, length: int, shift: np.ndarray) -> DataFrame:
    """(cid, codes): the part of the code in each table."""
    level = shift @ rotation
    powers = np.int64(1) << np.arange(length, dtype=np.int64)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                b = batch.slice(at, 2000)
                bits = (matrix(b.column("v"), dim) @ rotation >= level).reshape(b.num_rows, -1, length)
                codes = (bits @ powers).astype(np.int32)
                cuts = np.arange(0, codes.size + 1, codes.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("cid"), pa.ListArray.from_arrays(cuts, pa.array(codes.ravel()))], ["cid", "codes"]
                )

    return vectors.select("cid", "v").mapInArrow(run, "cid long, codes array<int>")


def dealt(codes: DataFrame, block: int) -> DataFrame:
    """(cid, tbl, part, at, lo, hi) for each bucket of two vectors or more: a row for each pair of blocks that a vector
    is in."""
    each = codes.select("cid", F.posexplode("codes").alias("tbl", "part"))
    sizes = save(each.groupBy("tbl", "part").agg(F.count("*").alias("size")).where("size > 1"))
    hot = sizes.where(F.col("size") > block)
    few = hot.count()
    if few:  # no join by bucket meets a bucket of more than a block, unless those are too many to be broadcast
        hot = F.broadcast(hot) if few <= MAX_HOT else hot
        cold = each.join(hot.select("tbl", "part"), ["tbl", "part"], "left_anti").join(sizes, ["tbl", "part"])
        each = cold.unionByName(each.join(hot, ["tbl", "part"]))
    else:
        each = each.join(sizes, ["tbl", "part"])
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    at = each.select("cid", "tbl", "part", blocks.alias("nb")).withColumn(
        "at", F.pmod(F.xxhash64(F.lit(3), "cid"), "nb").cast("int")
    )
    at = at.select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    return at.select(
        "cid", "tbl", "part", "at", F.least("at", "other").alias("lo"), F.greatest("at", "other").alias("hi")
    )


def candidates(
    cuts: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, most: int = 1 << 17
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows of one group, i < j, from both blocks where it has two; cuts: where groups begin, and the
    end. A portion holds most pairs or those of one row."""
    last = np.repeat(cuts[1:], np.diff(cuts))
    number = last - np.arange(len(last)) - 1
    upto = np.cumsum(number)
    start = 0
    while start < len(number):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, "right")))
        n = number[start:end]
        i = np.repeat(np.arange(start, end), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        ok = (lo[i] == hi[i]) | (at[i] != at[j])
        yield i[ok], j[ok]
        start = end


def reranked(rows: DataFrame, dim: int, least: float) -> DataFrame:
    """(id, links, root) per vector and bucket: linked vectors counted, and the smallest id connected there."""
    keys = ["tbl", "part", "lo", "hi"]

    def links_of(group: pa.Table) -> pa.RecordBatch:
        x = matrix(group.column("v"), dim)
        ids, n, at, tbl, lo, hi = (group.column(c).to_numpy() for c in ("id", "n", "at", "tbl", "lo", "hi"))
        codes = group.column("codes").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        changed = np.zeros(len(ids), bool)
        for c in keys:
            own = group.column(c).to_numpy()
            changed[1:] |= own[1:] != own[:-1]
        links, pairs = np.zeros(len(ids), np.int64), []
        for i, j in candidates(np.concatenate([[0], np.flatnonzero(changed), [len(ids)]]), at, lo, hi):
            ok = np.flatnonzero((np.einsum("ij,ij->i", x[i], x[j]) >= least) & (ids[i] != ids[j]))
            ok = ok[(codes[i[ok]] == codes[j[ok]]).argmax(1) == tbl[i[ok]]]  # else met before
            i, j = i[ok], j[ok]
            links += np.bincount(i, n[j], len(ids)).astype(np.int64) + np.bincount(j, n[i], len(ids)).astype(np.int64)
            pairs.append((i, j))
        i, j = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
        label = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
        while True:
            before = label.copy()
            np.minimum.at(label, i, before[j])
            np.minimum.at(label, j, before[i])
            if (label == before).all():
                break
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[some]), pa.array(links[some]), pa.array(np.sort(ids)[label[some]])], ["id", "links", "root"]
        )

    def run(batches):
        held: list[pa.RecordBatch] = []  # rows of the last group so far
        held_key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            last = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in keys)
            other = np.flatnonzero(
                np.logical_or.reduce([batch.column(c).to_numpy() != v for c, v in zip(keys, last, strict=True)])
            )
            at = int(other[-1]) + 1 if len(other) else 0
            if at or (held and held_key != last):
                yield links_of(pa.Table.from_batches([*held, *([batch.slice(0, at)] if at else [])]))
                held = []
            held.append(batch.slice(at))
            held_key = last
        if held:
            yield links_of(pa.Table.from_batches(held))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "id long, links long, root long")


def near_duplicates(
    rows: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    least: float = 0.95,
    sample: int = SAMPLE,
    block: int = 2000,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Vectors are linked when their cosine is least or more and the index brings them together, with a chance of RECALL at
    least, by what the sample's angles tell; none below least is linked. sample: the most vectors the rotations are learnt on, chosen by hash. Vectors
    that are null, empty, zero or hold null or non-finite components link with nothing; those of different lengths don't
    link either. Rows that repeat an id are one vector of several forms, whose links are added up; rows of a null id
    link with nothing. An empty table gives an empty result; other columns are ignored."""
    raw = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v"))
    fine = F.forall(
        "v", lambda z: F.coalesce(~F.isnan(z) & (F.abs(z) < float("inf")), F.lit(False))
    ) & F.exists("v", lambda z: z != 0)
    good = raw.where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False))).withColumn("h", F.xxhash64("v"))
    classes = save(
        good.groupBy("h", "v").agg(
            F.min("id").alias("id"), F.countDistinct("id").alias("n")
        ).withColumn("cid", F.monotonically_increasing_id())
    )
    found = None
    for (dim,) in classes.select(F.size("v")).distinct().collect():
        own = classes.where(F.size("v") == dim)
        x = unit(np.array([r.v for r in own.orderBy("h", "cid").limit(sample).select("v").collect()], np.float64))
        tables, length, shift = layout(own.count(), x, least)
        codes = save(encode(own, dim, hyperplanes(centred(x, shift), tables, length), length, shift))
        at = dealt(codes, block).join(own.join(codes, "cid").select("cid", "id", "n", "codes", "v"), "cid").drop("cid")
        one = reranked(at, dim, least)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return rows.select(
            vec_id,
            F.lit(0).cast("long").alias("n_links"),
            F.col(vec_id).cast("long").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    found = save(found)
    counts = found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    same = good.join(
        classes.select("h", "v", F.col("id").alias("rep"), "n"), ["h", "v"]
    ).select("id", "rep", "n").distinct()
    whole = save(
        components(
            found.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(
                same.select(F.col("id").alias("a"), F.col("rep").alias("b"))
            )
        )
    )
    links = same.join(counts, "rep", "left").groupBy("id").agg(
        F.sum(F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    out = rows.select(F.col(vec_id).alias("_vec")).join(
        links.withColumnRenamed("id", "_id"), F.col("_vec") == F.col("_id"), "left"
    ).join(whole, F.col("_vec") == F.col("node"), "left")
    component = F.coalesce("component", "_vec").cast("long")
    return out.select(
        F.col("_vec").alias(vec_id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("_vec"), F.lit(True)).alias("kept"),
    )


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0 AND len(list_filter(embedding, lambda z: z <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id WHERE r.c < l.b),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a), m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, m.c AS component_id, m.c = vec_id AS kept FROM embeddings LEFT JOIN n ON n.a = vec_id JOIN m ON m.id = vec_id
"""
