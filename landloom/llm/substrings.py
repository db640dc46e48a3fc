"""Substring dedup by seed and extend, on words.

Every run of length words selects, by winnowing, the least hash of its runs of seed words: an anchor that equal runs
share. Anchors are joined on their hash: each document meets the document of the smallest id that has the anchor, its
leader, once per leader. The pair is extended from the anchors both ways along their diagonals, and repeats of length
words or more are kept at their full extent. A run whose anchor the leader has but which the leader does not hold may
still stand in another document; such runs are themselves joined, whole, as seeds as long as the threshold, on the
smallest id. Partners of such a run have the same anchor and leader and are in the same position, so none is missed.

A passage that every third document holds costs one leader and a row per document, dealt over as many tasks as those
rows need. The pair step shuffles the texts of
documents that share an anchor, and the last step all texts, once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.common import (
    annotate,
    blocks,
    covered,
    even_join,
    forget,
    inside,
    look_up,
    mixed,
    prefixes,
    runs,
    save,
    signed,
    table,
    windows,
    winnow,
    word_table,
)

#: So many ids of 8 bytes are broadcast at most, to filter texts before they are shuffled; beyond, the join shuffles
#: them.
MAX_IDS = 1 << 20
MAX_DIAGONALS = 64


def only(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of docs whose key is among ids (saved, distinct)."""
    return docs.join(F.broadcast(ids) if ids.count() <= MAX_IDS else ids, key, "left_semi")


def anchors(words: np.ndarray, first: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of runs of seed words, anchor hash of each run of length words or 0, word hash prefix sums)."""
    sums = prefixes(words)
    grams = windows(sums, seed)
    least, _ = winnow(
        grams, length - seed + 1, inside(first, length, len(words) - length + 1)
    ) if len(words) >= length else (grams[:0], None)
    return grams, least, sums


def extend(
    x: np.ndarray, y: np.ndarray, seeds_x: np.ndarray, seeds_y: np.ndarray, seed: int, length: int
) -> np.ndarray:
    """At which words of x runs of length words begin that y holds on a diagonal of a shared anchor (hashes of words
    given).

    Where anchors repeat so often that there are more than MAX_DIAGONALS of them, runs are looked up whole instead."""
    out = np.zeros(max(0, len(x) - length + 1), bool)
    if not len(out) or len(y) < length:
        return out
    gx, gy = windows(prefixes(x), seed), windows(prefixes(y), seed)
    px, py = np.flatnonzero(np.isin(gx, seeds_x)), np.flatnonzero(np.isin(gy, seeds_y))
    order = py[np.argsort(gy[py], kind="stable")]
    left, right = np.searchsorted(gy[order], gx[px], "left"), np.searchsorted(gy[order], gx[px], "right")
    n = right - left
    if n.sum() <= 64 * (len(x) + len(y)):
        at = np.repeat(px, n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)
        shifts = np.unique(order[place] - at)
        if len(shifts) <= MAX_DIAGONALS:
            for d in shifts.tolist():
                lo, hi = max(0, -d), min(len(x), len(y) - d)
                a, b = runs(x[lo:hi] == y[lo + d : hi + d])
                for s, e in zip(a[b - a >= length], b[b - a >= length], strict=True):
                    out[lo + s : lo + e - length + 1] = True
            return out
    return np.isin(windows(prefixes(x), length), windows(prefixes(y), length)) & np.isin(
        windows(prefixes(mixed(x)), length), windows(prefixes(mixed(y)), length)
    )


def repeated_spans(docs: DataFrame, length: int = 50, seed: int = 20) -> DataFrame:
    """(doc_id, same, spans): the runs of words, as structs (start, end), that an earlier document holds, of
    docs(doc_id, text); same is a hash of the text. Spans may touch or overlap."""

    def seeds(column: pa.Array) -> dict:
        words, first = word_table(column)
        _, least, _ = anchors(words, first, length, seed)
        own = [
            np.unique(least[a : max(a, b - length + 1)])
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
        ]
        cuts = np.cumsum([0, *map(len, own)]).astype(np.int32)
        return {"h": pa.ListArray.from_arrays(cuts, pa.array(signed(np.concatenate([*own, least[:0]]))))}

    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    each = annotate(docs, "text", "h array<long>", seeds).select(
        F.col("row.doc_id").alias("doc_id"), F.explode("h").alias("h")
    )
    leaders = save(
        each.groupBy("h").agg(
            F.min("doc_id").alias("leader"), F.max("doc_id").alias("last"), F.count("*").alias("n")
        ).where("leader < last").drop("last")
    )
    hits = look_up(
        each, leaders, ["h"], ["doc_id"]
    ).where("doc_id > leader").groupBy("doc_id", "leader").agg(F.collect_set("h").alias("h"))
    hits = save(hits)
    followers = hits.groupBy("leader").agg(F.count("*").alias("n"))
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("same"))
    xs, ys = save(hits.select("doc_id").distinct()), save(hits.select(F.col("leader").alias("doc_id")).distinct())
    left = only(hashed, xs, "doc_id").join(hits, "doc_id")
    right = only(hashed, ys, "doc_id").select(
        F.col("doc_id").alias("leader"), F.col("text").alias("leading")
    ).distinct()

    def pair(batches):
        for part in blocks(batches, "text"):
            rows: list = []
            for x, y, h in zip(part.column("text"), part.column("leading"), part.column("h"), strict=True):
                both, first = word_table(pa.chunked_array([[x], [y]]).combine_chunks())
                own, other = both[: first[1]], both[first[1] :]
                asked = h.values.to_numpy().view(np.uint64)
                _, least, sums = anchors(own, np.array([0, len(own)]), length, seed)
                found = extend(own, other, asked, asked, seed, length)
                rest = np.flatnonzero(np.isin(least, asked) & ~found)
                a, b = runs(found)
                more = windows(sums, length)[rest], windows(prefixes(mixed(own)), length)[rest]
                rows.append(
                    (
                        a.tolist(),
                        (b + length - 1).tolist(),
                        signed(more[0]).tolist(),
                        signed(more[1]).tolist(),
                        rest.tolist(),
                    )
                )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("same"), *[pa.array(c, pa.list_(pa.int64())) for c in columns]],
                ["doc_id", "same", "a", "b", "h1", "h2", "at"],
            )

    found = save(
        even_join(
            left, right, "leader", ["doc_id"], followers
        ).select("doc_id", "same", "text", "leading", "h").mapInArrow(
            pair, "doc_id long, same long, a array<long>, b array<long>, h1 array<long>, h2 array<long>, at array<long>"
        )
    )
    rest = found.select(
        "doc_id", "same", F.explode(F.arrays_zip("h1", "h2", "at")).alias("z")
    ).select("doc_id", "same", "z.*")
    firsts = save(
        rest.groupBy("h1", "h2").agg(
            F.min("doc_id").alias("leader"), F.max("doc_id").alias("last"), F.count("*").alias("n")
        ).where("leader < last").drop("last")
    )
    more = look_up(rest, firsts, ["h1", "h2"], ["doc_id", "at"]).where("doc_id > leader").select(
        "doc_id", "same", F.struct(F.col("at").alias("start"), (F.col("at") + length).alias("end")).alias("span")
    )
    plain = found.select(
        "doc_id", "same", F.explode(F.arrays_zip(F.col("a").alias("start"), F.col("b").alias("end"))).alias("span")
    )
    out = save(plain.unionByName(more).groupBy("doc_id", "same").agg(F.collect_set("span").alias("spans")))
    forget(leaders, hits, xs, ys, found, firsts)
    return out


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 50, seed: int = 20
) -> DataFrame:
    """(row, n_words, n_removed, kept): every row with the words that stay, joined by single spaces.

    A word goes when a run of length words around it also begins in a document of a smaller id; repeats within one
    document stay. Null, empty and blank texts have no words. A null id is no document: nothing goes from such rows, and
    they lead nobody. Rows that repeat an id are one document of several texts. An empty table gives an empty result;
    other columns ride along in row."""
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spans = repeated_spans(plain, length, seed)
    rows = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text")
    ).withColumn("_same", F.xxhash64("_text"))
    held = rows.join(
        spans.select(F.col("doc_id").alias("_id"), F.col("same").alias("_same"), "spans"), ["_id", "_same"], "left"
    )

    def cut(batches):
        for part in blocks(batches, "_text"):
            out = []
            for x, s in zip(part.column("_text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                words = (x or "").encode().split()
                if s:
                    gone = covered(len(words), np.array([z["start"] for z in s]), np.array([z["end"] for z in s]))
                    out.append(
                        (
                            len(words),
                            int(gone.sum()),
                            b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]).decode(),
                        )
                    )
                else:
                    out.append((len(words), 0, b" ".join(words).decode()))
            n, k, kept = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(kept, pa.string())],
                ["row", "n_words", "n_removed", "kept"],
            )

    from pyspark.sql.types import StructType

    schema = StructType([rows.schema["row"], *StructType.fromDDL("n_words long, n_removed long, kept string")])
    return held.select("row", "_text", "spans").mapInArrow(cut, schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS h FROM d WHERE len(w) >= 50),
f AS (SELECT h, min(doc_id) AS first FROM x GROUP BY h),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM x JOIN f USING (h) WHERE first < doc_id),
v AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
s AS (SELECT v.doc_id, count(*) FILTER (g.k IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY v.k) FILTER (g.k IS NULL) AS kept FROM v LEFT JOIN g ON g.doc_id = v.doc_id AND g.k = v.k GROUP BY v.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN s USING (doc_id)
"""
