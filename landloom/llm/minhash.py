"""MinHash near-dedup by a multi-index Hamming join.

Each text's set of word shingles gets a signature of b-bit MinHash symbols. Two sets at the wanted similarity differ in
few symbols; max_errors() gives the number that all but tail of such pairs stay within. The signature is split into
chunks so that, by pigeonhole, two signatures within that distance agree in some chunk but for errors // chunks symbols.
Each chunk is indexed once for each choice of that many symbols left out, so every such pair shares at least one key,
whatever the data.

Links are then confirmed on full sets, and groups are connected components of confirmed links:

1. Equal sets are one class from the start.
2. In each bucket of a key all members are compared with the least one only: as many pairs as members.
3. What is left open are buckets of three or more whose members those links don't connect. While more than a
   block of members of one are outside its least member's component, those are compared with the least of them, as in
   2, as long as that links a third of them.
4. The members of buckets that are still open, each once, are gathered by connected component of those buckets. They are
   dealt over blocks, and pairs of blocks are compared inside the tasks, but for blocks of the largest component of
   confirmed links, which need not meet each other; only links between what isn't connected yet come out.

So no bucket's pairs are ever written, and a bucket of any size is spread over many tasks. Signatures and keys grow with
the number of documents, sets are made only for documents that share a key with another and come near it in size."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.common import (
    annotate,
    blocks,
    components,
    even_join,
    forget,
    inside,
    look_up,
    mixed,
    prefixes,
    save,
    signed,
    spans,
    table,
    unpack,
    windows,
    word_table,
)

#: Comparing with one more member of each open bucket goes on while one in so many pairs is a link.
SOME = 3
MULTIPLIERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


@lru_cache(maxsize=16)
def max_errors(m: int, similarity: float, tail: float = 1e-5) -> int:
    """The least d such that a pair at this similarity differs in more than d of m symbols with a chance below tail."""
    p, above = 1 - similarity, 1.0
    for d in range(m + 1):
        above -= comb(m, d) * p**d * (1 - p) ** (m - d)
        if above < tail:
            return d
    return m


@lru_cache(maxsize=16)
def layout(m: int, errors: int) -> tuple[tuple[tuple[int, ...], ...], int]:
    """Chunks of symbols, and how many may be left out of each: as few chunks as leave one error to each of them."""
    chunks = max(1, min(m // 2, ceil((errors + 1) / 2)))
    return tuple(tuple(range(c, m, chunks)) for c in range(chunks)), errors // chunks


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The distinct shingles (hashes) of each text: runs of k lower-cased words, or all of fewer words as one."""
    words, first = word_table(column, lower=True)
    sums = prefixes(mixed(words))
    grams = windows(sums, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        else:
            out.append(spans(sums, np.array([a]), np.array([b])) if b > a else words[:0])
    return out


def full_sets(column: pa.Array, k: int, m: int, signed_too: bool, bits: int = 16) -> dict[str, pa.Array]:
    """Sets of shingles, and their signatures where an id may have several."""
    sets = shingle_sets(column, k)
    sig = [signature(x, m, bits).tobytes() if signed_too and len(x) else None for x in sets]
    return {"shingles": pa.array([x.tobytes() for x in sets], pa.binary()), "sig": pa.array(sig, pa.binary())}


def signature(own: np.ndarray, m: int, bits: int) -> np.ndarray:
    best = np.full(m, np.uint64(2**64 - 1))
    for i in range(0, len(own), 4096):
        best = np.minimum(best, (own[i : i + 4096, None] * MULTIPLIERS[None, :m] + MULTIPLIERS[None, -m:]).min(0))
    return (mixed(best) >> np.uint64(64 - bits)).astype(np.uint16)


def sketch(docs: DataFrame, text: str, k: int, m: int, bits: int = 16) -> DataFrame:
    """(row, n_shingles, h1, h2, sig): h1 and h2 tell sets apart; sig holds the m symbols, two bytes each."""

    def make(column: pa.Array) -> dict:
        sets = shingle_sets(column, k)
        with np.errstate(over="ignore"):
            h1 = [int(signed(x.sum(dtype=np.uint64)[None])[0]) for x in sets]
            h2 = [int(signed(mixed(x).sum(dtype=np.uint64)[None])[0]) for x in sets]
        return {
            "n_shingles": [len(x) for x in sets],
            "h1": h1,
            "h2": h2,
            "sig": pa.array([signature(x, m, bits).tobytes() if len(x) else None for x in sets], pa.binary()),
        }

    return annotate(docs, text, "n_shingles long, h1 long, h2 long, sig binary", make)


def symbols(column: pa.Array, m: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, m)


def index_keys(classes: DataFrame, m: int, errors: int) -> DataFrame:
    """(key, id): for each chunk and each choice of symbols left out of it, the others' hash."""
    chunks, free = layout(m, errors)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = symbols(batch.column("sig"), m).astype(np.uint64)
            keys, ids = [], batch.column("id").to_numpy(zero_copy_only=False)
            for c, chunk in enumerate(chunks):
                for v, out in enumerate(combinations(range(len(chunk)), min(free, len(chunk) - 1))):
                    held = np.full(len(sig), np.uint64(c * 4096 + v + 1))
                    for j, s in enumerate(chunk):
                        if j not in out:
                            held = mixed(held * np.uint64(0x2545F4914F6CDD1D) + sig[:, s] + np.uint64(j))
                    keys.append(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(np.concatenate(keys))), pa.array(np.tile(ids, len(keys)))], ["key", "id"]
            )

    return classes.select("id", "sig").mapInArrow(run, "key long, id long")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sets as sorted arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.sort(np.concatenate([a, b]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b), saved, whose full sets are similar enough. One a may have very many b."""

    def run(batches):
        for part in blocks(batches, "sa"):
            keep = [
                linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(part.column("sa").to_pylist(), part.column("sb").to_pylist(), strict=True)
            ]
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    held = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    held = even_join(
        held,
        sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")),
        "a",
        ["b"],
        pairs.groupBy("a").agg(F.count("*").alias("n")),
    )
    return held.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def open_buckets(rows: DataFrame, part: DataFrame) -> DataFrame:
    """(key, id, p, component, head), saved: members rows(key, id, p) of the buckets whose members are in more than one
    component of part(node, component); head: the component of the bucket's least member p."""
    at = rows.join(part.withColumnRenamed("node", "id"), "id", "left")
    at = save(at.select("key", "id", "p", F.coalesce("component", "id").alias("component")))
    head = F.max(F.when(F.col("id") == F.col("p"), F.col("component"))).alias("head")
    several = F.min("component").alias("least"), F.max("component").alias("most")
    loose = at.groupBy("key").agg(*several, head, F.count("*").alias("n")).where("least < most")
    loose = save(loose.select("key", "head", "n"))
    out = save(look_up(at, loose, ["key"], ["id"]).select("key", "id", "p", "component", "head"))
    forget(at, loose)
    return out


def second_links(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, links), saved: in each open bucket, the members outside the head's component are compared with the least
    of them."""
    others = members.where("component <> head")
    reps = save(
        others.groupBy("key").agg(
            F.min("id").alias("rep"), F.min_by("component", "id").alias("own"), F.count("*").alias("n")
        ).where("n > 1")
    )
    pairs = look_up(others.select("key", "id", "component"), reps, ["key"], ["id"]).where("component <> own")
    pairs = save(pairs.select(F.col("rep").alias("a"), F.col("id").alias("b")).distinct())
    forget(reps)
    return pairs, save(confirm(pairs, sets, percent))


def in_blocks(members: DataFrame, m: int, errors: int, percent: int, block: int) -> DataFrame:
    """(a, b): links between members(lo, hi, deal, at, id, component, sig, shingles) of two blocks (or one) of a
    cluster, enough to connect what links connect."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sig = symbols(group.column("sig"), m)
        ids, at = group.column("id").to_numpy(), group.column("at").to_numpy()
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        _, label = np.unique(group.column("component").to_numpy(), return_inverse=True)
        n = np.array([len(x) for x in sets])
        found = []
        for i in np.flatnonzero(at == lo):
            others = (at == hi) & (np.arange(len(ids)) > (i if lo == hi else -1)) & (label != label[i]) & (
                100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])
            )
            others = np.flatnonzero(others)
            if len(others):
                others = others[(sig[others] != sig[i]).sum(1) <= errors]
            for j in others:
                if label[i] != label[j] and linked(sets[i], sets[j], percent):
                    found.append((ids[i], ids[j]))
                    label[label == label[j]] = label[i]
        return pa.table(
            {"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())}
        )

    return members.groupBy("deal", "lo", "hi").applyInArrow(run, "a long, b long")


def block_pairs(members: DataFrame, block: int) -> DataFrame:
    """(deal, lo, hi, at, id, component) of members(cluster, id, component): a row for each pair of blocks that a member
    is in.

    The members of a cluster's largest component are not compared with each other, so only blocks of the others meet
    all."""
    sizes = members.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("cluster").agg(
        F.max_by("component", F.struct("n", "component")).alias("large"),
        F.max("n").alias("inner"),
        F.sum("n").alias("n"),
    )
    number = lambda x: F.ceil(x / F.lit(block)).cast("int")
    sizes = save(
        sizes.where("n > inner").select(
            "cluster", "large", number(F.col("inner")).alias("nl"), number(F.col("n") - F.col("inner")).alias("no"), "n"
        )
    )
    at = look_up(members, sizes, ["cluster"], ["id"])
    own, slot = F.col("component") == F.col("large"), F.xxhash64(F.lit(5), "id")
    at = at.withColumn("at", F.when(own, F.pmod(slot, "nl")).otherwise(F.col("nl") + F.pmod(slot, "no")).cast("int"))
    at = at.select(
        "*", F.explode(F.sequence(F.when(own, F.col("nl")).otherwise(0), F.col("nl") + F.col("no") - 1)).alias("other")
    )
    lo, hi = F.least("at", "other"), F.greatest("at", "other")
    return at.select(
        F.xxhash64("cluster", lo, hi).alias("deal"), lo.alias("lo"), hi.alias("hi"), "at", "id", "component"
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    percent: int = 85,
    m: int = 40,
    tail: float = 1e-5,
    block: int = 1000,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row: the group of near-duplicates it is in.

    Texts are linked when 100 * intersection >= percent * union of their sets of distinct shingles of lower-cased words
    (fewer words: all of them as one). A pair whose similarity is exactly the threshold is missed with a chance of tail
    at most, a more similar one less; none is linked below it. component_id: the smallest id reachable; kept: it is the
    row's own. Null, empty and blank texts have no shingles and link with nothing, rows of null id neither: they are
    kept, and component_id is the own id. Rows that repeat an id are one document, which links by any of its texts, so
    all get the same component_id. An empty table gives an empty result; other columns are ignored."""
    errors = max_errors(m, percent / 100, tail)
    rows = save(
        sketch(
            docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).select("id", "text"),
            "text",
            shingle,
            m,
        ).select("row.id", "n_shingles", "h1", "h2", "sig")
    )
    same = ["h1", "h2", "n_shingles"]
    classes = save(
        rows.where("n_shingles > 0 AND id IS NOT NULL").groupBy(*same).agg(
            F.min("id").alias("id"), F.first("sig").alias("sig"), F.count("*").alias("n")
        )
    )
    repeated = save(rows.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n")).where("n > 1"))
    forms = None if repeated.isEmpty() else own_classes(rows, classes, repeated, same)
    several_forms = forms is not None
    keys = index_keys(classes, m, errors)
    held = save(keys.groupBy("key").agg(F.min("id").alias("p"), F.count("*").alias("n")).where("n > 1"))
    buckets = save(look_up(keys, held, ["key"], ["id"]).where("id <> p OR n > 2"))
    star = save(buckets.where("id <> p").select(F.col("p").alias("a"), F.col("id").alias("b")).distinct())
    degree = star.groupBy("a").agg(F.count("*").alias("n"))
    near = even_join(
        star, classes.select(F.col("id").alias("a"), F.col("n_shingles").alias("na")), "a", ["b"], degree
    ).join(classes.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb")), "b")
    near = save(near.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b"))
    several = buckets.where("n > 2").select("key", "id", "p")
    wanted = several.select("id").unionByName(
        near.select(F.col("a").alias("id"))
    ).unionByName(near.select(F.col("b").alias("id"))).distinct()
    texts = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")
    ).join(wanted, "id", "left_semi")
    sets = save(
        annotate(
            texts,
            "text",
            "shingles binary, sig binary",
            lambda c: full_sets(c, shingle, m, several_forms),
        ).select("row.id", "shingles", "sig").where(F.octet_length("shingles") > 0)
    )
    links = save(confirm(near, sets, percent))
    part = save(components(links.unionByName(forms) if several_forms else links))
    forget(held, star, near, links)

    open_ = open_buckets(several, part)
    while True:  # as long as very many are open in a bucket, and a comparison with one of them links a good part
        left = open_.where("component <> head").groupBy("key").count()
        if (left.agg(F.max("count")).first()[0] or 0) <= block:
            break
        pairs, links = second_links(open_, sets, percent)
        compared, found = pairs.count(), links.count()
        if found:
            whole = part.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)
            before, part = (part, open_), save(components(whole))
            open_ = open_buckets(before[1].select("key", "id", "p"), part)
            forget(*before)
        forget(pairs, links)
        if found * SOME < compared or not found:
            break
    edges = open_.select(F.col("component").alias("a"), F.col("head").alias("b")).distinct()
    members = save(open_.select("id", "component").distinct())
    clusters = components(edges).select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    clusters = save(clusters.join(members.groupBy("component").agg(F.count("*").alias("n")), "component"))
    dealt = block_pairs(look_up(members, clusters, ["component"], ["id"]).drop("n"), block)
    if several_forms:
        full = sets.withColumn("_h", F.xxhash64("shingles")).dropDuplicates(["id", "_h"]).drop("_h")
    else:
        full = classes.select("id", "sig").join(sets.drop("sig"), "id")
    more = save(in_blocks(dealt.join(full, "id"), m, errors, percent, block))
    whole = save(
        components(part.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    ) if not more.isEmpty() else part
    forget(buckets, sets, open_, members, clusters, more)

    plain = rows.drop("sig")
    some = F.coalesce(F.col("id").isNotNull() & (F.col("n_shingles") > 0), F.lit(False))
    reps = classes.select(*same, F.col("id").alias("_rep"), "n")
    # copies of one text, however many, don't meet in one task
    with_rep = look_up(plain.where(some), reps, same, ["id"]).select(*plain.columns, "_rep")
    out = with_rep.unionByName(plain.where(~some).withColumn("_rep", F.lit(None).cast("long")))
    out = out.join(whole.select(F.col("node").alias("_rep"), "component"), "_rep", "left").withColumn(
        "group", F.coalesce("component", "_rep", "id")
    )
    if several_forms:  # rows without words belong to their id's document
        least = out.where("_rep IS NOT NULL").groupBy("id").agg(F.min("group").alias("_least"))
        least = save(least.join(repeated, "id"))
        again = look_up(out.join(repeated.select("id"), "id", "left_semi"), least, ["id"], ["h1", "h2"])
        rest = out.join(least.select("id"), "id", "left_anti")
        out = rest.unionByName(again.withColumn("group", F.col("_least")).select(*rest.columns))
    group = F.col("group")
    return out.select(
        F.col("id").alias(doc_id),
        "n_shingles",
        group.alias("component_id"),
        F.coalesce(group == F.col("id"), F.lit(True)).alias("kept"),
    )


def own_classes(rows: DataFrame, classes: DataFrame, repeated: DataFrame, same: list[str]) -> DataFrame:
    """(a, b), saved: for ids with several texts, each class of its texts (by the class's id) and the least of these."""
    texts = rows.where("n_shingles > 0").join(repeated.select("id"), "id", "left_semi").select("id", *same).distinct()
    held = texts.join(classes.select(*same, F.col("id").alias("rep")), same).select("id", "rep").distinct()
    # an id is a class's own where it is the least of one, so both are linked to it
    return save(held.select(F.col("id").alias("a"), F.col("rep").alias("b")).where("a <> b"))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id. Rows that repeat an id are one document, and
    go or stay together: where one of its texts links it to a smaller id, its other texts go as well."""
    gone = near_duplicates(
        docs, shingle=shingle, percent=percent
    ).groupBy("doc_id").agg(F.min("kept").alias("_kept")).where("NOT _kept")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"))
    return rows.join(gone.select(F.col("doc_id").alias("_id")), "_id", "left_anti").select(*unpack(docs, docs.columns))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 1, 2)), lambda i: array_to_string(w[i:i + 2], ' ')))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id WHERE r.c < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, m.c = d.doc_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = d.doc_id
"""
