"""Benchmark decontamination by spaced-seed hashing.

Fixed masks over runs of tokens ignore some positions, so a hash survives substituted tokens that fall there. The masks
are chosen by the length of an item so that, wherever the substitutions fall that an overlap may hold, one of them
misses all. Hashes of benchmark and training texts are joined; each hit gives a diagonal (how far the item is shifted in
the text), and along it the two are compared token by token: a contaminated text holds a stretch of 20 tokens of an item
(or the whole of a shorter item) of which at least percent agree.

The benchmark's hashes are broadcast as a sorted array to drop other training hashes before the join, but only after
counting that they are at most max_filter; a larger benchmark joins without that filter, with the same result. Training
tokens are shuffled only for texts with a hit. A passage that every third text holds costs a row per text and item,
spread by text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.common import NOT_ALNUM, annotate, forget, inside, mixed, save, signed, table, unpack, word_table

#: Masks (1: the token counts) by the least number of tokens of an item that they serve: together they find a stretch of
#: so many tokens wherever the substitutions that PERCENT leaves it (1, 2, 3, 4) fall.
MASKS = {
    5: ("1111", "11101", "11011", "10111"),
    10: ("1111011", "11001111", "110110011", "11110101", "10101111"),
    15: ("110110111", "111010000111", "11100101101", "10101110011", "1011000010111", "1101010100011"),
    20: ("110110111", "111010000111", "111000001000111", "10110000101101"),
}
WINDOW, PERCENT = 20, 80
SALTS = 16
FACTORS = mixed(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xB5026F5AA96619E9)) | np.uint64(1)


def all_hashes(
    words: np.ndarray, first: np.ndarray, served: dict[int, np.ndarray | None]
) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, token at which they begin) within texts, of the tokens that masks keep. served: the entries of MASKS
    wanted, with the texts that each is for (None: all)."""
    hashes, places = [], []
    weight = max((m.count("1") for n in served for m in MASKS[n]), default=0)
    scaled = [words * f for f in FACTORS[:weight]]
    for n, texts in served.items():
        for k, mask in enumerate(MASKS[n]):
            size = len(words) - len(mask) + 1
            if size <= 0:
                continue
            ok = inside(first, len(mask), size)
            if texts is not None:
                ok &= np.repeat(texts, np.diff(first))[:size]
            own = np.full(size, mixed(np.uint64([64 * n + k]))[0])
            for f, j in enumerate(j for j, keep in enumerate(mask) if keep == "1"):
                own += scaled[f][j : j + size]
            at = np.flatnonzero(ok)
            hashes.append(own[at])
            places.append(at)
    return np.concatenate([*hashes, words[:0]]), np.concatenate([*places, np.zeros(0, np.int64)])


def serving(lengths: np.ndarray) -> dict[int, np.ndarray]:
    """The masks that texts of so many tokens need."""
    least = sorted(MASKS)
    at = np.searchsorted(least, lengths, "right") - 1
    return {n: at == k for k, n in enumerate(least) if (at == k).any()}


def _lists(hashes: np.ndarray, places: np.ndarray, first: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Hashes and places (from the text's first token) as one list for each text."""
    order = np.argsort(places, kind="stable")
    hashes, places = hashes[order], places[order]
    cuts = np.searchsorted(places, first).astype(np.int32)
    text = np.searchsorted(first, places, "right") - 1
    return pa.ListArray.from_arrays(cuts, pa.array(signed(hashes))), pa.ListArray.from_arrays(
        cuts, pa.array(places - first[text])
    )


def _tokens(words: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(first.astype(np.int32), pa.array(signed(words)))


def overlaps(doc: np.ndarray, item: np.ndarray, shift: int, window: int, percent: int) -> tuple[int, int, int]:
    """(start, end, agreeing) of the stretch of doc that agrees with item shifted by shift in windows; start = end:
    none."""
    w = min(window, len(item))
    lo, hi = max(0, shift), min(len(doc), shift + len(item))
    if hi - lo < w:
        return 0, 0, 0
    same = (doc[lo:hi] == item[lo - shift : hi - shift]).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(100 * (sums[w:] - sums[:-w]) >= percent * w)
    if not len(good):
        return 0, 0, 0
    a, b = int(good[0]), int(good[-1]) + w
    return lo + a, lo + b, int(sums[b] - sums[a])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    percent: int = PERCENT,
    max_filter: int = 1 << 21,
    by_text: bool = False,
) -> DataFrame:
    """(doc_id, item_id, start, end, agreeing): the longest overlap of each document and benchmark item that have one.

    Tokens are lower-cased runs of letters and digits. Every overlap of WINDOW tokens, or of all of a shorter item, of
    which percent (PERCENT or more) agree is found, wherever the others stand; items of fewer than 5 tokens are ignored.
    Null, empty and blank texts and items overlap with nothing. Rows of a null id are ignored, unless by_text is set:
    then each of their texts is a document, told by one more column, same (its xxhash64; null for documents with an id).
    Rows that repeat an id are one document of several texts, or one item. Other columns are ignored, and empty tables give an empty result."""
    if percent < PERCENT:
        raise ValueError(f"the masks find overlaps of {PERCENT} percent or more")

    def hashed(column: pa.Array) -> dict:
        words, first = word_table(column, lower=True, gaps=NOT_ALNUM)
        h, at = _lists(*all_hashes(words, first, serving(np.diff(first))), first)
        return {"words": _tokens(words, first), "h": h, "at": at}

    fields = "words array<long>, h array<long>, at array<long>"
    items = benchmark.select(
        F.col(item_id).alias("item_id"), F.col(item_text).alias("text")
    ).where("item_id IS NOT NULL AND text IS NOT NULL")
    items = save(
        annotate(items, "text", fields, hashed).where(F.size("words") >= min(MASKS)).select(
            F.col("row.item_id").alias("item_id"), "words", "h", "at"
        ).withColumn("variant", F.xxhash64("words")).dropDuplicates(["item_id", "variant"])
    )
    lengths = [r.n for r in items.select(F.least(F.size("words"), F.lit(max(MASKS))).alias("n")).distinct().collect()]
    served = dict.fromkeys(serving(np.array(lengths, np.int64)))
    spark = docs.sparkSession
    small = (items.agg(F.sum(F.size("h"))).first()[0] or 0) <= max_filter
    few = None
    if small:
        keys = items.select(F.explode("h").alias("h")).distinct()
        few = spark.sparkContext.broadcast(np.sort(keys.toPandas()["h"].to_numpy(np.int64).view(np.uint64)))
    slots: list[np.ndarray] = []

    def hits(column: pa.Array) -> dict:
        words, first = word_table(column, lower=True, gaps=NOT_ALNUM)
        h, at = all_hashes(words, first, served)
        if few is not None:
            known, low = few.value, np.uint64((1 << 22) - 1)
            if not slots:
                slots.append(np.zeros(1 << 22, bool))
                slots[0][(known & low).astype(np.int64)] = True
            near = np.flatnonzero(slots[0][(h & low).astype(np.int64)])
            if len(known):
                near = near[known[np.minimum(np.searchsorted(known, h[near]), len(known) - 1)] == h[near]]
            h, at = h[near], at[near]
        keys, places = _lists(h, at, first)
        used = np.flatnonzero(np.diff(keys.offsets.to_numpy()) > 0)
        mask = np.ones(len(first) - 1, bool)
        mask[used] = False
        tokens = _tokens(words, first)
        tokens = pa.ListArray.from_arrays(tokens.offsets, tokens.values, mask=pa.array(mask)) if len(mask) else tokens
        return {"words": tokens, "h": keys, "at": places}

    plain = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    ).where("text IS NOT NULL" if by_text else "doc_id IS NOT NULL AND text IS NOT NULL")
    held = save(
        annotate(plain, "text", fields, hits).where(F.size("h") > 0).select(
            "row.doc_id", "words", "h", "at", F.xxhash64("row.text").alias("same")
        ).dropDuplicates(["doc_id", "same"])
    )
    # what every third text holds is spread: a small benchmark is broadcast, a large one is dealt several times
    salt = F.lit(0) if small else F.pmod(F.xxhash64("doc_id", "same"), F.lit(SALTS)).cast("int")
    every = F.lit(0) if small else F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    side = F.broadcast if small else (lambda x: x)
    seen = held.select(
        "doc_id", "same", salt.alias("salt"), F.explode(F.arrays_zip("h", "at")).alias("z")
    ).select("doc_id", "same", "salt", "z.h", F.col("z.at").alias("d"))
    asked = items.select("item_id", "variant", F.explode(F.arrays_zip("h", "at")).alias("z")).select(
        "item_id", "variant", "z.h", F.col("z.at").alias("i"), every.alias("salt")
    )
    shifts = seen.join(side(asked), ["h", "salt"]).select(
        "doc_id", "same", "item_id", "variant", "salt", (F.col("d") - F.col("i")).alias("shift")
    )
    shifts = shifts.groupBy("doc_id", "same", "item_id", "variant", "salt").agg(F.collect_set("shift").alias("shifts"))
    words_of = held.select(F.col("doc_id").alias("_doc"), F.col("same").alias("_same"), F.col("words").alias("dw"))
    alike = (F.col("same") == F.col("_same")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    pairs = shifts.join(words_of, alike).drop("_doc", "_same")
    pairs = pairs.join(
        side(items.select("item_id", "variant", F.col("words").alias("iw"), every.alias("salt"))),
        ["item_id", "variant", "salt"],
    )

    def verify(batches):
        for batch in batches:
            rows = []
            for d, same, i, shifts_, dw, iw in zip(
                *[batch.column(c) for c in ("doc_id", "same", "item_id", "shifts", "dw", "iw")], strict=True
            ):
                doc, item = dw.values.to_numpy(), iw.values.to_numpy()
                best = max(
                    (overlaps(doc, item, x, WINDOW, percent) for x in shifts_.values.to_pylist()),
                    key=lambda x: (x[1] - x[0], x[2], -x[0]),
                )
                if best[1] > best[0]:
                    rows.append((d.as_py(), same.as_py(), i.as_py(), *best))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "same", "item_id", "start", "end", "agreeing"]
            )

    found = pairs.select(
        F.col("doc_id").cast("long"), "same", F.col("item_id").cast("long"), "shifts", "dw", "iw"
    ).mapInArrow(verify, "doc_id long, same long, item_id long, start long, end long, agreeing long")
    found = found.withColumn("same", F.when(F.col("doc_id").isNull(), F.col("same")))
    best = F.max_by(
        F.struct("start", "end", "agreeing"), F.struct(F.col("end") - F.col("start"), "agreeing", -F.col("start"))
    ).alias("b")
    keys = ["doc_id", "same", "item_id"] if by_text else ["doc_id", "item_id"]
    out = save(found.groupBy(*keys).agg(best).select(*keys, "b.*"))
    forget(items, held)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no benchmark item. Rows of one id go or stay together; rows of a null id are
    judged each by its own text."""
    found = contamination(docs, benchmark, by_text=True)
    ids = found.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct()
    texts = found.where("doc_id IS NULL").select(F.col("same").alias("_id")).distinct()
    row = F.struct("*").alias("row")
    named = docs.where("doc_id IS NOT NULL").select(row, F.col("doc_id").alias("_id"))
    others = docs.where("doc_id IS NULL").select(row, F.xxhash64("text").alias("_id"))
    rows = named.join(ids, "_id", "left_anti").unionByName(others.join(texts, "_id", "left_anti"))
    return rows.select(*unpack(docs, docs.columns))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, contaminated, n_items, longest (tokens of the longest overlap, else 0), items (ids, ascending)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    by = found.groupBy(F.col("doc_id").alias("_id")).agg(
        F.count("*").alias("n"),
        F.max(F.col("end") - F.col("start")).alias("longest"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
    )
    out = docs.select("doc_id").join(by, F.col("doc_id") == F.col("_id"), "left")
    return out.select(
        "doc_id",
        F.col("n").isNotNull().alias("contaminated"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("longest", F.lit(0)).cast("long").alias("longest"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
    )
