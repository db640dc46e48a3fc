"""Toxicity: maximum-scoring segment search over token log-odds, calibrated by extreme-value statistics.

Training counts in how many labelled documents of either class each token stands, and scores tokens by log-odds with an
informative Dirichlet prior (the corpus frequency of the token). A document is then scanned once, in linear time, for
all maximal segments whose summed scores are positive; tokens without a score cost a little, so a segment ends where
nothing supports it. The best segment of n tokens of clean text follows an extreme-value law with parameters lambda and
K, so x = lambda * S - ln(K * n) is comparable between short and long documents. All segments of a document are
aggregated by sum statistics: how unlikely it is that clean text has its r best segments together, for the r that is
least likely. A logistic curve turns that into a score.

Law and curve are fitted crosswise: on labelled documents scanned with tokens learnt from the other half of them. So is
how certain a token's score must be to count at all: of several limits, that with the least log-loss.

Counting and scoring are map-side sums and maps; the model holds the tokens of at most max_labels documents that tell
the classes apart. Labels of documents whose crc32(doc_id as text) mod 5 is 0 are never read."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.common import (
    BYTE_VALUES,
    LOWER,
    NOT_ALNUM,
    annotate,
    blocks,
    forget,
    mixed,
    prefixes,
    save,
    signed,
    spans,
    table,
    unpack,
    utf8,
    windows,
    word_bounds,
    word_table,
)

FOLDS = 5
#: A token must be at least so certain (z) to count; which of these is chosen crosswise.
LIMITS = (2.5, 3.0, 3.5, 4.0, 4.5, 5.0)
#: A token counts as itself and, so that inflected and compound forms count too, as its first so many bytes.
STEMS = (6, 7, 8, 9)
EULER = 0.5772156649015329
BIN, LOW, BINS = 0.25, -20.0, 400


@dataclass
class Model:
    tokens: np.ndarray  # sorted hashes
    scores: np.ndarray
    certain: np.ndarray  # |z| of the scores
    drift: float = 0.1
    rate: float = 1.0  # lambda
    log_k: float = 0.0
    usual: float = 0.0  # mean logarithm of a clean text's tokens
    significant: float = 3.0  # the least x of a passage that is reported: once in 20 clean texts
    slope: float = 1.0
    offset: float = 0.0  # of the logistic curve


def held_out(doc_id):
    """The documents whose labels are not for learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (token, token or stem) of all tokens, 0 where a token has no such stem; at which token each text
    begins."""
    data, offsets = utf8(column)
    starts, ends, first = word_bounds(data, offsets, NOT_ALNUM)
    sums = prefixes(BYTE_VALUES[LOWER[data]])
    out = np.zeros((len(starts), 1 + len(STEMS)), np.uint64)
    out[:, 0] = spans(sums, starts, ends)
    for k, n in enumerate(STEMS, 1):
        long = ends - starts > n
        out[long, k] = spans(sums, starts[long], starts[long] + n) ^ np.uint64(n)
    return out, first


COUNTS = "token long, clean0 double, toxic0 double, clean1 double, toxic1 double"


def _counts(batches):
    """The weight of clean and toxic documents of either half in which each token stands, summed over the partition."""
    keys, sums = np.zeros(0, np.uint64), np.zeros((0, 4))
    kept: list = []

    def merge():
        nonlocal keys, sums, kept
        k = np.concatenate([keys, *[x[0] for x in kept]])
        n = np.concatenate([sums, *[x[1] for x in kept]])
        order = np.argsort(k)
        k, n = k[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
        keys, sums, kept = k[first], np.add.reduceat(n, first) if len(first) else n, []

    def rows():
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(keys)), *[pa.array(np.ascontiguousarray(sums[:, c])) for c in range(4)]],
            [x.split()[0] for x in COUNTS.split(", ")],
        )

    for part in blocks(batches, "text"):
        words, first = features(part.column("text"))
        toxic, weight, half = (part.column(c).to_numpy(zero_copy_only=False) for c in ("toxic", "weight", "half"))
        for column in range(4):
            own = [
                (np.unique(words[a:b]), w) for a, b, t, w, h in zip(
                    first[:-1], first[1:], toxic > 0, weight, half, strict=True
                )
                if 2 * h + t == column
            ]
            if own:
                k, inverse = np.unique(np.concatenate([x for x, _ in own]), return_inverse=True)
                n = np.zeros((len(k), 4))
                n[:, column] = np.bincount(inverse, np.repeat([w for _, w in own], [len(x) for x, _ in own]), len(k))
                kept.append((k[k > 0], n[k > 0]))
        if sum(len(x[0]) for x in kept) > 1 << 18:
            merge()
        if len(keys) > 1 << 19:
            yield rows()
            keys, sums = keys[:0], sums[:0]
    merge()
    yield rows()


def least_shingle(column: pa.Array) -> pa.Array:
    """The least hash of each text's runs of three words (null for fewer): near-copies mostly share it."""
    out: list[int | None] = []
    for part in blocks(iter([pa.RecordBatch.from_arrays([column], ["text"])]), "text"):
        words, first = word_table(part.column("text"), lower=True, gaps=NOT_ALNUM)
        grams = windows(prefixes(mixed(words)), 3)
        out += [
            int(signed(grams[a : b - 2].min()[None])[0])
            if b - a > 2
            else None for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
        ]
    return pa.array(out, pa.int64())


def segments(sums: np.ndarray, hits: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), given running sums (one more than tokens) and where scores are
    positive: a segment joins the one before that began lower if it ends higher.

    Each segment keeps the one at which its search for a lower beginning ended; a later search that passes the segment
    goes on from there, as all between began higher. So the scan is linear."""
    # running sum before, running sum after, start, end, where the search ended
    found: list[tuple[float, float, int, int, int]] = []
    for i in hits.tolist():
        low, high, start, j = float(sums[i]), float(sums[i + 1]), i, len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= low:
                j = found[j][4]
            if j < 0 or found[j][1] >= high:
                break
            low, _, start, _, before = found[j]
            del found[j:]
            j = before
        found.append((low, high, start, i + 1, j))
    return [(a, b, high - low) for low, high, a, b, _ in found]


def passages(
    column: pa.Array, model: Model, limits: tuple[float, ...] = (0.0,)
) -> tuple[np.ndarray, list[list[list[tuple[int, int, float]]]]]:
    """(number of tokens of each text, and per limit all maximal segments of each). A token's score is that of its most
    telling form; tokens whose scores are less certain than the limit (z) count as without one."""
    words, first = features(column)
    each, z = np.zeros(len(words)), np.zeros(len(words))
    if len(model.tokens):
        at = np.minimum(np.searchsorted(model.tokens, words), len(model.tokens) - 1)
        known = model.tokens[at] == words
        each, z = np.where(known, model.scores[at], 0.0), np.where(known, model.certain[at], 0.0)
    found = []
    for limit in limits:
        scores = np.full(len(words), -model.drift)
        if len(model.tokens):
            own = np.where(z >= limit, each, 0.0)
            scores += own[np.arange(len(own)), np.abs(own).argmax(1)]
        sums = np.concatenate([[0.0], np.cumsum(scores)])
        positive = np.flatnonzero(scores > 0)
        cuts = np.searchsorted(positive, first)
        some = [segments(sums, positive[a:b]) if b > a else [] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        found.append([[(a - int(at), b - int(at), s) for a, b, s in own] for own, at in zip(some, first, strict=False)])
    return np.diff(first), found


def standard(model: Model, n: int, score: float) -> float:
    """x = lambda * S - ln(K * n)."""
    return model.rate * score - model.log_k - math.log(max(1, n))


def together(model: Model, n: int, scores: list[float]) -> float:
    """How unlikely the segments of n tokens are in clean text: the largest, over r, of minus the logarithm of the
    chance that the x of the r best add up to what they do, e^-t t^(r-1) / (r! (r-1)!), times 2^r for the choice of r.

    A text without any segment counts as of the usual length at least: that it is short doesn't make it suspect."""
    if not scores:
        return -model.log_k - max(math.log(max(1, n)), model.usual) - math.log(2)
    x = sorted((standard(model, n, s) for s in scores), reverse=True)
    best, total = x[0] - math.log(2), x[0]
    for r, y in enumerate(x[1:], 2):
        if y <= 0:
            break
        total += y
        if total > r * (r - 1):  # where the law holds
            best = max(best, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2))
    return best


def scan(column: pa.Array, model: Model) -> dict:
    """FIELDS of each text: number of tokens, best segment, all significant ones, and all together."""
    n, (found,) = passages(column, model)
    out: dict[str, list] = {"n": n.tolist(), "best": [], "value": [], "best_start": [], "best_end": [], "segments": []}
    for k, own in zip(n.tolist(), found, strict=True):
        top = max(own, key=lambda x: x[2], default=(0, 0, 0.0))
        for c, v in zip(("best_start", "best_end", "best"), top, strict=True):
            out[c].append(v)
        out["value"].append(together(model, k, [s for *_, s in own]))
        out["segments"].append(
            [{"start": a, "end": b, "x": x} for a, b, s in own if (x := standard(model, k, s)) >= model.significant]
        )
    return out | {
        "segments": pa.array(
            out["segments"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("x", pa.float64())]))
        )
    }


FIELDS = "n long, best double, value double, best_start long, best_end long, segments array<struct<start:long,end:long,x:double>>"


def curve(bins: list[tuple[float, float, float]]) -> tuple[float, float, float]:
    """Slope (0 or more) and offset of a logistic curve over (value, clean, toxic) counts, by Newton steps with a weak
    prior, and the logarithm of how unlikely the labels are by it."""
    x, clean, toxic = (np.array(v, float) for v in zip(*bins, strict=True))
    mean, spread = np.average(x, weights=clean + toxic), max(
        1e-3, np.sqrt(np.cov(x, aweights=clean + toxic)) if len(x) > 1 else 1.0
    )
    z = np.stack([np.ones_like(x), (x - mean) / spread], 1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (toxic - (clean + toxic) * p) - 0.02 * w
        step = np.linalg.solve((z.T * ((clean + toxic) * p * (1 - p))) @ z + 0.02 * np.eye(2), gradient)
        w += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    slope = max(0.0, w[1] / spread)
    offset = w[0] - slope * mean
    loss = clean * np.logaddexp(0, slope * x + offset) + toxic * np.logaddexp(0, -slope * x - offset)
    return slope, offset, float(loss.sum())


def law(m) -> dict[str, float]:
    """lambda, ln K and the usual length from means of the best segment s, the logarithm l of the length, and their
    products: the variance of lambda * s - l is to be that of the extreme-value law, pi^2 / 6; its mean gives K."""
    vs, vl, c = m.ss - m.s * m.s, m.ll - m.l * m.l, m.sl - m.s * m.l
    rate = min(5.0, max(0.05, (c + math.sqrt(max(0.0, c * c - vs * (vl - math.pi**2 / 6)))) / vs)) if vs > 1e-9 else 1.0
    return {"rate": rate, "usual": m.l, "log_k": rate * m.s - m.l - EULER}


def fit(
    docs: DataFrame, labels: DataFrame, max_labels: int = 1 << 17, prior: float = 500.0, drift: float = 0.1
) -> Model:
    """Learn from labels(doc_id, toxic) of documents that are not held out: from max_labels of them at most, chosen by
    hash (two megabytes, which are broadcast, so that no text is shuffled).

    Rows without an id, a label or a text don't count; where an id has several labels, the largest holds. Without
    documents of both classes there is nothing to learn, and every score is 0. Documents alike share one document's
    weight, so that a text copied a thousand times doesn't make each of its words telling; they are in the same half."""
    own = labels.where(
        "doc_id IS NOT NULL AND toxic IS NOT NULL"
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id"))).orderBy(
        F.xxhash64("doc_id"), "doc_id"
    ).limit(max_labels)
    train = docs.select("doc_id", "text").where("text IS NOT NULL").where(
        ~held_out(F.col("doc_id"))
    ).join(F.broadcast(own), "doc_id")
    plain = save(
        train.select(
            "doc_id", "text", F.col("toxic").cast("int").alias("toxic")
        ).withColumn("alike", F.arrow_udf(least_shingle, "long")("text"))
    )
    groups = save(
        plain.where("alike IS NOT NULL").groupBy("alike").agg((1 / F.count("*")).alias("weight")).where("weight < 1")
    )
    half = F.pmod(F.xxhash64(F.coalesce("alike", "doc_id")), F.lit(2)).cast("int")
    train = plain.join(F.broadcast(groups) if groups.count() <= max_labels else groups, "alike", "left").select(
        "text", "toxic", half.alias("half"), F.coalesce("weight", F.lit(1.0)).alias("weight")
    )
    counts = save(
        train.mapInArrow(_counts, COUNTS).groupBy("token").agg(
            *[F.sum(x.split()[0]).alias(x.split()[0]) for x in COUNTS.split(", ")[1:]]
        )
    )

    def learn(clean, toxic) -> Model:
        """Token scores from columns of counts."""
        model = Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), drift)
        all_clean, all_toxic = counts.agg(F.sum(clean), F.sum(toxic)).first()
        if all_clean and all_toxic:
            a = F.lit(0.5) + prior * (clean + toxic) / F.lit(float(all_clean + all_toxic))
            t, c = toxic + a, clean + a
            odds = F.log(t / (F.lit(all_toxic + prior) - t)) - F.log(c / (F.lit(all_clean + prior) - c))
            telling = counts.select(
                "token", odds.alias("s"), F.abs(odds / F.sqrt(1 / t + 1 / c)).alias("z"), (clean + toxic).alias("n")
            ).where((F.col("z") >= LIMITS[0]) & (F.col("n") > 0)).select("token", "s", "z").toPandas()
            tokens = telling["token"].to_numpy(np.int64).view(np.uint64)
            order = np.argsort(tokens)
            model.tokens, model.scores, model.certain = tokens[
                order
            ], telling["s"].to_numpy(float)[order], telling["z"].to_numpy(float)[order]
        return model

    column = {x: F.col(x) for x in ("clean0", "toxic0", "clean1", "toxic1")}
    model = learn(column["clean0"] + column["clean1"], column["toxic0"] + column["toxic1"])
    if len(model.tokens):
        others = [learn(column["clean1"], column["toxic1"]), learn(column["clean0"], column["toxic0"])]

        def crosswise(batches):
            for part in blocks(batches, "text"):
                for h, other in enumerate(others):
                    own = part.filter(pc.equal(part.column("half"), h))
                    n, found = passages(own.column("text"), other, LIMITS)
                    for k, some in enumerate(found):
                        scores = pa.array([[s for *_, s in x] for x in some], pa.list_(pa.float64()))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(some), k, np.int32)),
                                own.column("toxic"),
                                own.column("weight"),
                                pa.array(n),
                                scores,
                            ],
                            ["k", "toxic", "weight", "n", "scores"],
                        )

        scored = save(train.mapInArrow(crosswise, "k int, toxic int, weight double, n long, scores array<double>"))
        ln, best, w = F.log(
            F.greatest(F.col("n"), F.lit(1)).cast("double")
        ), F.coalesce(F.array_max("scores"), F.lit(0.0)), F.col("weight")
        mean = lambda x: F.sum(w * x) / F.sum(w)
        moments = scored.where("toxic <= 0").groupBy("k").agg(
            mean(best).alias("s"),
            mean(ln).alias("l"),
            mean(best * best).alias("ss"),
            mean(ln * ln).alias("ll"),
            mean(best * ln).alias("sl"),
        ).collect()
        laws = {m.k: replace(model, **law(m)) for m in moments}

        def binned(batches):
            for batch in batches:
                ks = batch.column("k").to_pylist()
                x = np.array(
                    [
                        together(laws.get(k, model), n, s) for k, n, s in zip(
                            ks, batch.column("n").to_pylist(), batch.column("scores").to_pylist(), strict=True
                        )
                    ],
                    float,
                )
                at = np.clip(np.floor((x - LOW) / BIN), 0, BINS - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k"), pa.array(at), batch.column("toxic"), batch.column("weight")],
                    ["k", "bin", "toxic", "weight"],
                )

        weigh = lambda y: F.sum(F.when(y, w).otherwise(0.0))
        bins = scored.mapInArrow(binned, "k int, bin long, toxic int, weight double").groupBy("k", "bin").agg(
            weigh(F.col("toxic") <= 0).alias("clean"), weigh(F.col("toxic") > 0).alias("toxic")
        ).orderBy("k", "bin").collect()
        curves = {
            k: curve(
                [(LOW + BIN * (b.bin + 0.5), b.clean, b.toxic) for b in bins if b.k == k]
            ) for k in sorted({b.k for b in bins})
        }
        k = min(curves, key=lambda k: (curves[k][2], -k))
        sure = model.certain >= LIMITS[k]
        model = replace(
            laws.get(k, model),
            tokens=model.tokens[sure],
            scores=model.scores[sure],
            certain=model.certain[sure],
            slope=curves[k][0],
            offset=curves[k][1],
        )
        forget(scored)
    forget(plain, groups, counts)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row, n, best, value, best_start, best_end, segments, score): every row with its best and its significant
    passages (in tokens, with x), all of them together as value, and its score.

    Null and empty texts have no passage and get the score of one; equal texts get equal scores, however long. An empty
    table gives an empty result; other columns ride along in row."""
    out = annotate(docs, "text", FIELDS, lambda column: scan(column, model))
    if not len(model.tokens):
        return out.withColumn("score", F.lit(0.0))
    return out.withColumn(
        "score", 1 / (1 + F.exp(-F.lit(float(model.slope)) * F.col("value") - F.lit(float(model.offset))))
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below threshold. Null, empty and short texts without a passage stay; without labels
    of both classes, and so for empty tables, everything stays. Rows that repeat an id are judged one by one."""
    return score(docs, fit(docs, labels)).where(F.col("score") < threshold).select(*unpack(docs, docs.columns))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.col("n").alias("n_words"),
        F.size("segments").cast("long").alias("n_segments"),
        "best_start",
        "best_end",
        "segments",
    )
