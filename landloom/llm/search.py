"""Ranked lexical search over a term-partitioned index, pipelined: bundles of items carry sparse accumulators of documents
through successive stages, each of which owns a part of the terms.

Documents are indexed in shards of at most SHARD: one row for each shard and wanted term, with the places of its
documents, how often they hold it and how long they are. A term's owner goes by its weight, so the first stages own rare
terms, and common ones meet accumulators that are already telling. A stage cogroups the bundles of a shard with the
postings of its terms and adds integer contributions. What cannot reach the shard's k best documents, even if all later
terms of its item counted in full, is left behind; that loses nothing. After the last stage each shard has at most k
documents an item, of which a window picks the k best of all.

A group is one shard and one bundle, whatever a term's share of the documents or an item's of the terms. Of the items
only a table of 2^20 flags is broadcast, which tells which words of documents some item may hold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landloom.llm.common import NOT_ALNUM, annotate, blocks, even_join, forget, save, signed, table, word_table

#: Documents in a shard, postings after which one is closed early, items in a bundle, stages.
SHARD, CLOSE, BUNDLE, STAGES = 4096, 1 << 21, 256, 4
#: Flags of the words that items may hold.
FLAGS = 1 << 20
#: No contribution of a term is more than its weight times this, 10^9 tf div (1000 tf + 20 m) being less.
MOST = 1_000_000


def _numbered(rows: DataFrame, size: int) -> DataFrame:
    """rows with (bundle, local): local is below size, and no two rows have the same pair."""
    from pyspark.sql.types import StructType

    schema = StructType([*rows.schema, *StructType.fromDDL("bundle long, local int")])

    def run(batches):
        base, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            at = np.arange(seen, seen + batch.num_rows)
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base + at // size), pa.array((at % size).astype(np.int32))], schema.names
            )

    return rows.mapInArrow(run, schema)


def _index(docs: DataFrame, wanted) -> DataFrame:
    """(shard, term, df, at, tf, n, ids): a row for each shard and term that wanted (a broadcast of FLAGS flags) lets
    through: places of the documents in the shard, occurrences, lengths; and for each shard a row without a term: ids
    and lengths of all its documents, in the order of their ids."""

    def shard_rows(key: int, ids: list, lengths: list, docs_: list, terms: list) -> pa.RecordBatch:
        ids, lengths = pa.concat_arrays(ids), np.concatenate(lengths)
        order = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at, h = place[np.concatenate(docs_)], np.concatenate(terms)
        by = np.lexsort((at, h))
        at, h = at[by], h[by]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (at[1:] != at[:-1])
        one = np.flatnonzero(fresh)
        tf = np.diff(np.append(one, len(h)))
        at, h = at[one], h[one]
        lengths = lengths[order]
        cut = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        edges = np.concatenate([cut, [len(h)], [len(h)]])  # the last row has no postings
        n = np.concatenate([lengths[at], lengths])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(cut) + 1, key)),
                pa.array([*signed(h[cut]).tolist(), None], pa.int64()),
                pa.array(np.diff(edges)),
                pa.ListArray.from_arrays(edges.astype(np.int32), pa.array(at.astype(np.int32))),
                pa.ListArray.from_arrays(edges.astype(np.int32), pa.array(tf.astype(np.int32))),
                pa.ListArray.from_arrays(np.append(edges[:-1], len(n)).astype(np.int32), pa.array(n)),
                pa.ListArray.from_arrays(
                    np.append(np.zeros(len(cut) + 1, np.int32), np.int32(len(ids))), ids.take(pa.array(order))
                ),
            ],
            ["shard", "term", "df", "at", "tf", "n", "ids"],
        )

    def run(batches):
        key, held, postings = TaskContext.get().partitionId() << 32, 0, 0
        parts: tuple[list, ...] = ([], [], [], [])
        for part in blocks(batches, "text"):
            done = 0
            while done < part.num_rows:
                now = part.slice(done, SHARD - held)
                done += now.num_rows
                words, first = word_table(now.column("text"), lower=True, gaps=NOT_ALNUM)
                keep = np.flatnonzero(wanted.value[(words & np.uint64(FLAGS - 1)).astype(np.int64)])
                own = (now.column("doc_id"), np.diff(first), np.searchsorted(first, keep, "right") - 1 + held)
                for x, y in zip(parts, (*own, words[keep]), strict=True):
                    x.append(y)
                held, postings = held + now.num_rows, postings + len(keep)
                if held >= SHARD or postings >= CLOSE:
                    yield shard_rows(key, *parts)
                    key, held, postings, parts = key + 1, 0, 0, ([], [], [], [])
        if held:
            yield shard_rows(key, *parts)

    plan = "shard long, term long, df long, at array<int>, tf array<int>, n array<long>, ids array<long>"
    return docs.mapInArrow(run, plan)


def _lists(table_: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and where each row's begin (one more at the end)."""
    x = table_.column(column).combine_chunks()
    x = pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x
    return x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()


def _stage(stage: int, k: int, n_docs: int, n_terms: int, last: bool):
    """The work of a term owner on one shard and bundle: accumulators in, postings added, accumulators out."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        shard, bundle = (bundles if bundles.num_rows else postings).select(["shard", "bundle"]).slice(0, 1).to_pylist()[0].values()
        sums: dict[int, np.ndarray] = {}
        after: dict[int, list[int]] = {}
        if bundles.num_rows:
            at, edges = _lists(bundles, "at")
            score = _lists(bundles, "score")[0]
            for j, (local, bounds) in enumerate(
                zip(bundles.column("local").to_pylist(), bundles.column("after").to_pylist(), strict=True)
            ):
                sums[local], after[local] = np.zeros(SHARD, np.int64), bounds
                sums[local][at[edges[j] : edges[j + 1]]] = score[edges[j] : edges[j + 1]]
        if postings.num_rows:
            at, edges = _lists(postings, "at")
            tf, n = _lists(postings, "tf")[0].astype(np.int64), _lists(postings, "n")[0]
            m = 50 + (50 * n * n_docs) // n_terms
            gain = (1_000_000_000 * tf) // (1000 * tf + 20 * m)
            for j, (w, who) in enumerate(
                zip(postings.column("w").to_pylist(), postings.column("who").to_pylist(), strict=True)
            ):
                places, add = at[edges[j] : edges[j + 1]], w * gain[edges[j] : edges[j + 1]]
                for x in who:
                    local = x["local"]
                    if local not in sums:
                        sums[local], after[local] = np.zeros(SHARD, np.int64), x["after"]
                    sums[local][places] += add
        rows: list[tuple] = []
        for local, total in sums.items():
            seen = np.flatnonzero(total)
            if len(seen) > k:
                least = np.partition(total[seen], -k)[-k]
                seen = seen[total[seen] + MOST * after[local][stage] >= least]
            if last:
                seen = seen[np.lexsort((seen, -total[seen]))[:k]]
            if len(seen):
                rows.append((local, after[local], seen.astype(np.int32), total[seen]))
        edges = np.cumsum([0, *[len(r[2]) for r in rows]]).astype(np.int32)
        joined = lambda i, kind: np.concatenate([np.zeros(0, kind), *[r[i] for r in rows]])
        return pa.Table.from_arrays(
            [
                pa.array(np.full(len(rows), shard)),
                pa.array(np.full(len(rows), bundle)),
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                pa.ListArray.from_arrays(edges, pa.array(joined(2, np.int32))),
                pa.ListArray.from_arrays(edges, pa.array(joined(3, np.int64))),
            ],
            ["shard", "bundle", "local", "after", "at", "score"],
        )

    return run


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    stages: int = STAGES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest scores above 0 of each item, equal scores by
    ascending id, a null id last.

    Terms are lower-cased (A-Z only) runs of ASCII letters, digits and all characters beyond ASCII, told apart by 64-bit
    hashes. A score sums, over an item's distinct terms, w * ((10^9 tf) div (1000 tf + 20 m)), with w = floor(1000
    ln((2N + 2) / (2df + 1))) and m = 50 + (50 n N) div L: N documents hold a term, L terms in all, n in the document.
    Null, empty and blank texts hold no terms: such documents count for nothing, such items have no rows. Rows of
    documents that repeat an id are ranked each on its own, null ids too; rows that repeat an item's id, or lack one,
    are one item of all their terms. Ids are whole numbers or cast to them. Other columns are ignored, whatever their
    names, and empty tables give an empty result."""
    spark = docs.sparkSession
    asked = annotate(
        items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")),
        "text",
        "terms array<long>",
        lambda column: {"terms": _term_lists(column)},
    )
    asked = asked.select("row.item_id", F.explode("terms").alias("term")).groupBy("item_id")
    asked = save(_numbered(asked.agg(F.collect_set("term").alias("terms")), BUNDLE))
    slots = asked.select(F.explode("terms").alias("t")).select(F.expr(f"t & {FLAGS - 1}").alias("t")).distinct()
    flags = np.zeros(FLAGS, bool)
    flags[slots.toPandas()["t"].to_numpy(np.int64)] = True
    wanted = spark.sparkContext.broadcast(flags)

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    index = save(_index(plain, wanted))
    shards, held = index.where("term IS NULL"), index.where("term IS NOT NULL")
    size = shards.select(
        F.size(F.filter("n", lambda x: x > 0)).cast("long").alias("docs"),
        F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b).alias("terms"),
    ).agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = size[0] or 0, max(size[1] or 0, 1)

    counts = held.groupBy("term").agg(F.sum("df").alias("df"), F.count("*").alias("n"))
    per_item = asked.select("bundle", "local", F.explode("terms").alias("term"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    top = int(1000 * np.log(2.0 * n_docs + 2)) + 1
    terms = save(
        counts.join(per_item.select("term").distinct(), "term").select("term", "n", weight.alias("w"))
        .withColumn("owner", F.expr(f"least({stages - 1}, ({top} - w) * {stages} div {top})").cast("int"))
    )
    wholes = per_item.join(terms, "term")
    bounds = wholes.groupBy("bundle", "local").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("owner") > s, F.col("w"))), F.lit(0)) for s in range(stages)]).alias(
            "after"
        )
    )
    asks = save(
        wholes.join(bounds, ["bundle", "local"])
        .groupBy("term", "bundle", "w", "owner").agg(F.collect_list(F.struct("local", "after")).alias("who"))
    )
    postings = save(
        even_join(held.drop("ids"), asks, "term", ["shard"], terms.select("term", "n")).select(
            "shard", "bundle", "owner", "w", "who", "at", "tf", "n"
        )
    )
    plan = "shard long, bundle long, local int, after array<long>, at array<int>, score array<long>"
    bundles = spark.createDataFrame([], plan)
    for s in range(stages):
        owned = postings.where(F.col("owner") == s).groupBy("shard", "bundle")
        work = _stage(s, k, n_docs, n_terms, s == stages - 1)
        bundles = bundles.groupBy("shard", "bundle").cogroup(owned).applyInArrow(work, plan)
    best = bundles.join(shards.select("shard", "ids"), "shard").select(
        "bundle", "local", "ids", F.explode(F.arrays_zip("at", "score")).alias("x")
    )
    best = best.select("bundle", "local", F.get("ids", F.col("x.at")).alias("doc_id"), F.col("x.score").alias("score"))
    first = Window.partitionBy("bundle", "local").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = best.where("score > 0").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    out = save(
        best.join(asked.select("bundle", "local", "item_id"), ["bundle", "local"])
        .select("item_id", "rank", "doc_id", "score")
    )
    forget(asked, index, terms, asks, postings)
    return out


def _term_lists(column: pa.Array) -> pa.Array:
    words, first = word_table(column, lower=True, gaps=NOT_ALNUM)
    return pa.ListArray.from_arrays(first.astype(np.int32), pa.array(signed(words)))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
size AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM len),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, size WHERE term IN (SELECT term FROM asked) GROUP BY term, nd),
gains AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nt))) AS g
  FROM tf JOIN weights USING (term) JOIN len USING (doc_id), size),
scores AS (SELECT item_id, doc_id, sum(g)::BIGINT AS score FROM asked JOIN gains USING (term) GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""
