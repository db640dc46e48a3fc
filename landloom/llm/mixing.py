"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.
Built-in functions only.

A source's target is weight x level, but at most max_epochs times its size; the level is such that the targets add up to
the words asked for. With the sources in order of cap / weight the level follows from running sums, in one pass and
without iterating. Each document is then taken a whole number of times, and those that come first in the order of a
seeded hash once more, until the source's target is met.

A source may hold a third of all rows, so its order is not made in one task: words are summed per (source, first 20 bits
of the hash), running sums over those at most 4096 x 256 small sums find where the cut lies in two steps of 4096 and 256
slots, and only the documents of the slot with the cut are put in order one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landloom.llm.common import look_up, save, table

WEIGHTS = (5, 2, 1)
WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) for sizes(source, source_size): one row per source, a null source last.

    Weights repeat over the sources in code point order. share: of all words, what the mix is to hold; where it is above
    what max_epochs times all sources give, every source stands at its cap. Only one row per source is put in order
    here."""
    w = F.element_at(
        F.array(*[F.lit(x) for x in weights]),
        (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1,
    )
    out = sizes.select(
        "source", "source_size", w.cast("long").alias("_w"), (F.col("source_size") * max_epochs).alias("_cap")
    )
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    out = out.select(
        "*",
        (F.sum("source_size").over(Window.partitionBy()) * F.lit(share)).alias("_all"),
        (F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cap")).alias("_below"),
        F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("_left"),
    )
    out = out.withColumn("_full", F.col("_cap") * F.col("_left") <= (F.col("_all") - F.col("_below")) * F.col("_w"))
    free = F.when(~F.col("_full"), F.col("_w"))
    level = (
        F.max("_all").over(Window.partitionBy()) - F.coalesce(
            F.sum(F.when(F.col("_full"), F.col("_cap"))).over(Window.partitionBy()), F.lit(0)
        )
    ) / F.sum(free).over(Window.partitionBy())
    return out.select(
        "source",
        "source_size",
        F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(F.col("_w") * level).alias("target"),
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """(doc_id, size, source_size, target, copies): how often the mix takes each row.

    size: words of a document (null or empty text: 0). A source's share of whole repetitions is the same for all its
    documents; the rest goes to those that come first by md5(seed:doc_id), as far as the middle of a document lies
    before the cut, so a source misses its target by half a document at most and a document is taken at most max_epochs
    times. Reruns agree. A null source is a source of its own; rows of a null id are ordered by a hash of their text,
    rows of equal ids are told apart by size and text, and rows alike in all are interchangeable. A source without words has
    target 0 and its documents 0 or whole copies of nothing. An empty table gives an empty result; other columns are
    ignored."""
    marked = _marked(docs, doc_id, source, text, seed)
    return _taken(marked, weights, share, max_epochs).select("doc_id", "size", "source_size", "target", "copies")


def _marked(docs: DataFrame, doc_id: str, source: str, text: str, seed: str) -> DataFrame:
    """(doc_id, source, size, mark, same), saved: mark gives the order, and same tells texts apart."""
    # rows without an id are spread by their texts, so that they don't share one place in the order
    mark = F.md5(
        F.concat(
            F.lit(seed + ":"),
            F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.xxhash64(text).cast("string"))),
        )
    )
    return save(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            mark.alias("mark"),
            F.xxhash64(text).alias("same"),
        )
    )


def _taken(sized: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int) -> DataFrame:
    """The columns of _marked(), source_size, target and copies."""
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    goal = save(
        goal.select(
            "*",
            F.when(
                F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
            ).otherwise(0).alias("whole"),
        )
    )
    goal = goal.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    alike = F.col("source").eqNullSafe(F.col("_source"))

    def cut(rows: DataFrame, slot, before) -> DataFrame:
        """The slot of each source in which the running sum passes rest, and the sum before it."""
        sums = rows.groupBy("source", slot.alias("slot")).agg(
            F.sum("size").alias("n"), F.first(before).alias("b"), F.first("rest").alias("rest")
        )
        upto = F.col("b") + F.sum("n").over(Window.partitionBy("source").orderBy("slot"))
        return sums.withColumn("upto", upto).where(F.col("upto") > F.col("rest")).groupBy(
            F.col("source").alias("_source")
        ).agg(
            F.min("slot").alias("slot"), F.min_by(F.col("upto") - F.col("n"), "slot").alias("before")
        )

    slots = F.substring("mark", 1, 3), F.substring("mark", 4, 2)
    with_goal = sized.join(goal.withColumnRenamed("source", "_source"), alike).drop("_source")
    first = save(cut(with_goal, slots[0], F.lit(0)))
    at = with_goal.join(
        first, alike, "left"
    ).drop("_source").withColumnRenamed("slot", "slot1").withColumnRenamed("before", "before1")
    second = save(cut(at.where(slots[0] == F.col("slot1")), slots[1], F.col("before1")))
    at = at.join(
        second, alike, "left"
    ).drop("_source").withColumnRenamed("slot", "slot2").withColumnRenamed("before", "before2")
    inside = (slots[0] == F.col("slot1")) & (slots[1] == F.col("slot2"))
    clear = F.col("slot1").isNull() | (slots[0] < F.col("slot1")) | (
        (slots[0] == F.col("slot1")) & (F.col("slot2").isNull() | (slots[1] < F.col("slot2")))
    )
    middle = F.col("before2") + F.sum("size").over(
        Window.partitionBy("source").orderBy("mark", "doc_id", "size", "same").rowsBetween(Window.unboundedPreceding, 0)
    ) - F.col("size") / 2
    plain = at.where(~F.coalesce(inside, F.lit(False))).withColumn("more", clear.cast("long"))
    near = at.where(inside).withColumn("more", (middle <= F.col("rest")).cast("long"))
    out = plain.unionByName(near)
    extra = F.when(F.col("rest") > 0, F.col("more")).otherwise(0)
    return out.select(
        "doc_id", "source", "mark", "same", "size", "source_size", "target", (F.col("whole") + extra).alias("copies")
    )


def _keys(doc_id, source, same) -> list:
    """Two hashes of what tells rows apart; a null is told from any value."""
    parts = [x for c in (doc_id, source, same) for x in (F.isnull(c), c)]
    return [F.xxhash64(*parts).alias("_k1"), F.xxhash64(F.lit(31), *parts).alias("_k2")]


def mix_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """The rows of documents that the mix takes, once each, with copies: how often a training run repeats them.

    Every row gets what mix() takes of it. Rows that are alike in id, source and text share what is taken of them evenly;
    where that leaves some over, which only a source's last such group does, those first in the order of docs' partitions
    get one more: docs should be a stored table, or one whose partitions are the same when it is read again."""
    marked = _marked(docs, "doc_id", "source", "text", seed)
    taken = _taken(marked, weights, share, max_epochs).select(
        *_keys(F.col("doc_id"), F.col("source"), F.col("same")), "copies"
    )
    groups = taken.groupBy("_k1", "_k2").agg(F.count("*").alias("n"), F.sum("copies").cast("long").alias("_all"))
    groups = save(groups.selectExpr("_k1", "_k2", "n", "_all div n AS _each", "_all % n AS _more").where("_all > 0"))
    rows = docs.select(
        F.struct("*").alias("_row"),
        *_keys(F.col("doc_id"), F.col("source"), F.xxhash64("text")),
        F.spark_partition_id().alias("_part"),
    )
    found = look_up(rows, groups, ["_k1", "_k2"], ["_part"])
    plain = found.where("_more = 0").select("_row", F.col("_each").alias("_copies"))
    if not groups.where("_more > 0").isEmpty():
        odd = found.where("_more > 0")
        keys = ["_k1", "_k2", "_part"]
        upto = Window.partitionBy("_k1", "_k2").orderBy("_part")
        before = odd.groupBy(*keys).agg(F.count("*").alias("_held")).select(
            *keys, (F.sum("_held").over(upto) - F.col("_held")).alias("_before")
        )
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
        odd = odd.withColumn("_place", place).join(before, keys)
        more = (F.col("_place") + F.col("_before") <= F.col("_more")).cast("long")
        plain = plain.unionByName(odd.select("_row", (F.col("_each") + more).alias("_copies")))
    return plain.where("_copies > 0").select(
        *[F.col("_row").getField(c).alias(c) for c in docs.columns if c != "copies"], F.col("_copies").alias("copies")
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size, md5('mix:' || doc_id::VARCHAR) AS mark FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w, source_size * 3 AS cap FROM s),
o AS (SELECT *, sum(source_size) OVER ()::BIGINT AS total,
  (sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING) - cap)::BIGINT AS below,
  (sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS lft FROM w),
f AS (SELECT *, cap * lft <= (total - below) * w AS full_up FROM o),
t AS (SELECT source, source_size, CASE WHEN full_up THEN cap::DOUBLE ELSE
  w * ((max(total) OVER () - coalesce(sum(cap) FILTER (full_up) OVER (), 0))::DOUBLE / (sum(w) FILTER (NOT full_up) OVER ())::DOUBLE) END AS target FROM f),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
q AS (SELECT d.*, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS rest,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.mark, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size / 2 AS middle
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM q
"""
