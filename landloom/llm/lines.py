"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop lines over the threshold,
reassemble by position. Built-in functions only.

Only hashes are shuffled for counting. A hash that every third document holds is summed before the shuffle and broadcast
to its lines, so no task gathers a line's documents. A document's text moves once, to meet the list of its dropped
lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.common import ascii_lower, look_up, save, table

#: Stripped from both ends of a line before it is compared.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line):
    """A line as it is compared: [\\x20\\x09-\\x0D] stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """(row, n_lines, n_dropped, kept): every row, as a struct, with the lines that stay, joined by newlines.

    A key of min_chars code points or more that at least min_docs documents hold keeps its lines only in the document of
    the smallest id. Null or empty text: one empty line, which stays. Rows that repeat an id count as one document. A
    null id counts as no document; lines of such rows go if enough other documents hold them. Equal lines in one
    document stand or fall together. An empty table gives an empty result; other columns ride along in row, whatever
    their names."""
    rows = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).alias("_id"), F.coalesce(text, F.lit("")).alias("_text")
    )
    rows = rows.select("*", F.xxhash64("_text").alias("_same"))
    lines = rows.select("_id", "_same", F.posexplode(F.split("_text", "\n", -1)).alias("_at", "_line"))
    keyed = lines.select(
        "_id", "_same", "_at", line_key("_line").alias("_key")
    ).where(F.char_length("_key") >= min_chars)
    hashed = keyed.select(
        "_id",
        "_same",
        "_at",
        F.xxhash64("_key").alias("_h1"),
        F.xxhash64(F.lit(77), "_key", F.char_length("_key")).alias("_h2"),
    )
    by = hashed.groupBy("_h1", "_h2")
    if min_docs == 2:
        held = by.agg(
            F.min("_id").alias("_first"), F.max("_id").alias("_last"), F.count("*").alias("n")
        ).where("_first < _last")
    else:
        held = by.agg(
            F.min("_id").alias("_first"), F.countDistinct("_id").alias("_docs"), F.count("*").alias("n")
        ).where(F.col("_docs") >= min_docs)
    held = save(held.select("_h1", "_h2", "_first", "n"))
    gone = look_up(hashed, held, ["_h1", "_h2"], ["_id", "_at"]).where(~F.col("_id").eqNullSafe(F.col("_first")))
    gone = gone.groupBy(F.col("_id").alias("_in"), F.col("_same").alias("_as")).agg(F.collect_set("_at").alias("_gone"))
    whole = rows.select("row", "_id", "_same", F.split("_text", "\n", -1).alias("_lines"))
    joined = whole.join(gone, F.col("_id").eqNullSafe(F.col("_in")) & (F.col("_same") == F.col("_as")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    return joined.select(
        "row",
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone")).cast("long").alias("n_dropped"),
        F.when(F.col("_gone").isNull(), F.array_join("_lines", "\n")).otherwise(
            F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
        ).alias("kept"),
    )


def dedup_documents(docs: DataFrame) -> DataFrame:
    """documents without their repeated lines; n_chars is the length of what is left.

    A document goes only when all the lines it had with anything in them are gone; one that was blank before stays."""
    out = line_dedup(docs)
    out = out.where((F.col("n_dropped") == 0) | (F.length(F.btrim("kept", F.lit(BLANKS))) > 0))
    changed = {
        "text": F.when(F.col("n_dropped") == 0, F.col("row.text")).otherwise(F.col("kept")),
        "n_chars": F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.char_length("kept").cast("long")),
    }
    return out.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


SQL = """
WITH ls AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
ks AS (
  SELECT doc_id, line, pos, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM ls),
held AS (SELECT k, min(doc_id) AS first FROM ks WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
flagged AS (SELECT ks.*, held.k IS NOT NULL AND ks.doc_id <> held.first AS gone FROM ks LEFT JOIN held ON ks.k = held.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""
