"""The pipeline's stages on the smallest tables, each judged on its own input and against a plain version."""

import os
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute

import corpus_pipeline
from landloom.llm import toxicity
from landloom.llm.common import save, table

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def stages(spark, docs, folder):
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = save(stage(spark, docs, folder))
        seen.append((name, docs, out))
        docs = out
    return seen


def text(df):
    return {r.doc_id: r.text for r in df.collect()}


def plain_score(model, words):
    """A text's score, by trying every segment."""
    hashes, _ = toxicity.features(pa.array([" ".join(words)]))
    known = dict(zip(model.tokens.tolist(), model.scores.tolist(), strict=True))
    scores = []
    for forms in hashes.tolist():
        each = [known.get(h, 0.0) for h in forms]
        scores.append(max(each, key=abs) - model.drift)

    def maximal(a, b):
        best = max(
            ((sum(scores[i:j]), i - j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0, 0)
        )
        return maximal(a, best[2]) + [best[0]] + maximal(best[3], b) if best[0] > 0 else []

    return 1 / (
        1 + np.exp(-model.slope * toxicity.together(model, len(scores), maximal(0, len(scores))) - model.offset)
    )


@pytest.mark.skipif(not os.path.exists(DIR), reason="needs the given tables")
def test_stages(spark):
    docs = table(spark, DIR, "documents")
    columns, seen = docs.columns, stages(spark, docs, DIR)
    assert [s[0] for s in seen] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    assert all(o.columns == columns for _, _, o in seen[:-1]) and seen[-1][2].columns == [*columns, "copies"]

    (_, before, after) = seen[1]
    plain = brute.line_dedup(list(text(before).items()))
    want = {i: kept for i, _, n, kept in plain if not n or kept.strip(" \t\n\x0b\x0c\r")}
    assert {i: t or "" for i, t in text(after).items()} == {i: kept or "" for i, kept in want.items()}

    (_, before, after) = seen[2]
    groups = brute.near_duplicates(list(text(before).items()), 5, 80)
    assert text(after).keys() == {i for i, (_, c) in groups.items() if i == c}

    (_, before, after) = seen[3]
    items = [(r.item_id, r.text) for r in table(spark, DIR, "benchmark").collect()]
    near = {w for _, t in items for w in (t or "").lower().split()}
    some = [
        (i, t) for i, t in text(before).items() if i % 4 == 0 or sum(w in near for w in (t or "").lower().split()) > 10
    ]
    gone = {i for i, _ in brute.contaminated(some, items)}
    assert {i for i, _ in some} & text(after).keys() == {i for i, _ in some} - gone

    (_, before, after) = seen[4]
    rows = after.collect()
    assert all(r.copies in (1, 2, 3) for r in rows) and text(after).keys() <= text(before).keys()
    sizes, taken, largest = {}, {}, {}
    for r in before.collect():
        n = len(brute.words(r.text))
        sizes[r.source], largest[r.source] = sizes.get(r.source, 0) + n, max(largest.get(r.source, 0), n)
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.copies * len(brute.words(r.text))
    for source, goal in brute.targets(sizes).items():
        assert abs(taken.get(source, 0) - goal) <= largest[source] / 2 + 1


def test_toxicity_stage(spark):
    from test_corpus_operators import labelled

    rows, labels = labelled(300)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = {
        r.doc_id for r in toxicity.drop_toxic(
            docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        ).collect()
    }
    short = [(i, t.split()) for i, t in rows if len(t.split()) <= 40]
    assert len(short) > 50 and all((i in kept) == (plain_score(model, w) < 0.5) for i, w in short)


@pytest.mark.parametrize("rows", [0, 1], ids=["empty tables", "nulls, blanks and repeated rows"])
def test_stages_on_awkward_tables(spark, tmp_path, rows):
    some = [
        (1, None),
        (None, "a null id"),
        (2, ""),
        (3, "  \n "),
        (4, "one"),
        (4, "one"),
        (5, "word " * 30_000),
        (6, "shared line of text\nx"),
        (7, "shared line of text\ny"),
        (None, None),
    ] * rows
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in some], DOCS).withColumns(
        {"row": F.lit(1), "_id": F.lit("x"), "copies": F.lit(9), "id": F.lit(None).cast("string")}
    )
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(
        [(1, None), (None, "x")] * rows, "item_id long, text string"
    ).write.parquet(f"{tmp_path}/benchmark.parquet")
    seen = stages(spark, docs, str(tmp_path))
    assert all(o.columns == docs.columns for _, _, o in seen[:-1]) and set(seen[-1][2].columns) == set(docs.columns)
    kept = [sorted(((r.doc_id, r.text) for r in o.collect()), key=str) for _, _, o in seen[:-1]]
    assert kept[0] == sorted(some, key=str)
    if rows:
        assert (7, "y") in kept[1] and (6, "shared line of text\nx") in kept[1] and len(kept[1]) == len(some)
        assert kept[2] == kept[1] == kept[3]
