"""Each corpus operator against a plain version, on rows with nulls, blanks, copies, ties, long texts and clashing names."""

import hashlib
import random
import sys
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute

from landloom.llm import (
    common, decontam, embeddings, licenses, lines, minhash, mixing, secrets, substrings, suffixes, toxicity
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdeéß漢", k=r.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(r.choices(vocabulary, k=n))
    passage, line = prose(80), "A line that MANY documents share "
    out = [(i, prose(r.randint(0, 160))) for i in range(60)]
    out += [(100 + i, f"{prose(30)} {passage} {prose(20)}") for i in range(6)] + [
        (110 + i, f"{prose(10)}\n{line}{' ' * i}\n{prose(10)}") for i in range(6)
    ]
    base = prose(200).split()
    for i in range(30):
        w = list(base)
        for _ in range(i // 2):
            w[r.randrange(len(w))] = "x" + str(r.random())
        out.append((200 + i, " ".join(w)))
    out += [(300 + i, out[5][1] + " " + passage) for i in range(4)]
    out += [
        (400, None),
        (401, ""),
        (402, "  \t\n "),
        (403, "one"),
        (404, "one"),
        (405, "a b"),
        (406, "the " * 3000),
        (407, "the " * 2500),
        (408, "ab" * 4000),
        (409, prose(9000)),
        (410, "\n".join([line] * 5)),
    ]
    return out


def frame(spark, rows, **more):
    return spark.createDataFrame(
        [(i, t, "en", f"s{(i or 0) % 3}" if (i or 0) % 7 else None, len(t or "")) for i, t in rows], DOCS
    ).withColumns(
        {
            "row": F.lit(1),
            "id": F.lit("clash"),
            "_text": F.lit("x"),
            "n": F.lit(None).cast("int"),
            "h": F.lit(0),
            **more,
        }
    )


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(params=[common.LEAST, 2], ids=["plain", "hot"])
def least_hot(request, monkeypatch):
    """With hot keys from three rows on, their joins take the ways of keys that hold a third of all rows."""
    monkeypatch.setattr(common, "LEAST", request.param)


def test_line_dedup(spark, rows, least_hot):
    rows = [*rows, (None, "A line that MANY documents share"), (5, rows[5][1])]
    got = lines.line_dedup(frame(spark, rows)).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.line_dedup(rows), key=str)
    assert lines.line_dedup(frame(spark, rows[:0])).count() == 0
    kept = lines.dedup_documents(
        spark.createDataFrame(
            [
                (1, "shared line of text", "en", "s", 19),
                (2, "shared line of text", "en", "s", 19),
                (3, None, "en", "s", 0),
            ],
            DOCS,
        )
    )
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_mixing(spark, rows):
    rows = [*rows, (None, "some words here"), (5, rows[5][1])]
    out = mixing.mix(frame(spark, rows)).collect()
    assert len(out) == len(rows) and out and sorted(map(tuple, out), key=str) == sorted(
        map(tuple, mixing.mix(frame(spark, rows).repartition(5)).collect()), key=str
    )
    assert all(0 <= r.copies <= 3 and r.size >= 0 for r in out) and all(
        r.target <= 3 * r.source_size + 1e-6 for r in out
    )
    by = {}
    for r in out:
        by.setdefault(r.source_size, [r.target, 0, 0])
        by[r.source_size][1] += r.size * r.copies
        by[r.source_size][2] = max(by[r.source_size][2], r.size)
    assert abs(sum(v[0] for v in by.values()) - sum(r.size for r in out)) < 1e-6
    assert all(abs(t - n) <= big / 2 + 1 for t, n, big in by.values())
    assert mixing.mix(frame(spark, rows[:0])).count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_mixing_of_rows_without_an_id(spark, parts, least_hot):
    """Very many of them, some with equal texts: each source's target is met within half a document."""
    r = random.Random(6)
    rows = [(None, " ".join("w" * r.randint(1, 9)), "abc"[r.randrange(3)]) for _ in range(200)]
    rows += [(None, "the same five words here", "a")] * 300 + [(k % 40, "an id of six words each", "b") for k in range(300)]
    rows += [(None, None, "a")] * 9 + [(None, "x y", None)] * 50
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], DOCS).withColumn("copies", F.lit(7))
    out = mixing.mix_documents(docs.repartition(parts, "source", "text", "doc_id"))
    taken, sizes, largest = {}, {}, {}
    for q in out.collect():
        assert 1 <= q.copies <= 3
        taken[q.source] = taken.get(q.source, 0) + q.copies * len(brute.words(q.text))
    for _, t, s in rows:
        n = len(brute.words(t))
        sizes[s], largest[s] = sizes.get(s, 0) + n, max(largest.get(s, 0), n)
    for s, goal in brute.targets(sizes).items():
        assert abs(taken.get(s, 0) - goal) <= largest[s] / 2 + 1, s


def test_decontamination_of_rows_without_an_id(spark):
    item = " ".join(f"q{k}" for k in range(30))
    docs = [(None, f"before {item} after"), (None, f"before {item} after"), (None, "clean text of some words"), (None, None), (3, item), (3, "other text"), (4, "clean text of some words")]
    kept = decontam.drop_contaminated(frame(spark, docs), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(((x.doc_id, x.text) for x in kept.collect()), key=str) == sorted([docs[2], docs[3], docs[6]], key=str)


def test_mixing_caps_and_reshares(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 100)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 30 and got["c"] == 0 and got[None] == 300 and abs(got["b"] - 780) < 1e-9


def test_near_duplicates(spark, rows, least_hot):
    rows = [*rows, (5, rows[5][1])]
    got = {
        r.doc_id: (r.n_shingles, r.component_id)
        for r in minhash.near_duplicates(frame(spark, [*rows, (None, rows[0][1])]), block=7).collect()
    }
    assert got.pop(None)[1] is None and got == brute.near_duplicates(rows)
    assert minhash.near_duplicates(frame(spark, rows[:0])).count() == 0


def test_near_duplicates_of_ids_with_several_texts(spark, least_hot):
    """All texts of an id are one document: it has one component, and what any of its texts links to is in it."""
    r = random.Random(4)
    prose = lambda: [r.choice("abcdefgh") + str(r.randrange(500)) for _ in range(60)]
    a, b, c = prose(), prose(), prose()
    near = lambda w: " ".join(["zz", *w[1:]])
    rows = [(1, " ".join(a)), (5, " ".join(a)), (5, " ".join(b)), (9, " ".join(b)), (5, ""), (7, near(b)), (7, None), (20, near(c)), (21, " ".join(c)), (21, near(a)), (30, "alone"), (30, "apart"), (31, "apart")]
    for k in range(40):  # ids that share classes in chains, and one with very many texts
        rows += [(100 + k, f"chain {k} " + "x " * 9 + str(k)), (100 + k, f"chain {k + 1} " + "x " * 9 + str(k + 1)), (99, f"own {k} text")]
    got = sorted((q.doc_id, q.component_id, q.kept) for q in minhash.near_duplicates(frame(spark, rows), block=3).collect())
    sets = [brute.shingle_set(t, 3) for _, t in rows]
    alike = lambda i, j: rows[i][0] == rows[j][0] or (
        bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    )
    part = brute.components(range(len(rows)), alike)
    least = {}
    for k, p in part.items():
        least[p] = min(least.get(p, rows[k][0]), rows[k][0])
    assert got == sorted((rows[k][0], least[p], least[p] == rows[k][0]) for k, p in part.items())
    kept = {q.doc_id for q in minhash.keep_one(frame(spark, rows), shingle=3, percent=85).collect()}
    assert kept == {i for i, _, own in got if own}


def test_hot_keys_have_an_absolute_limit(spark, monkeypatch):
    monkeypatch.setattr(common, "LEAST", 10)
    monkeypatch.setattr(common, "MOST", 50)
    monkeypatch.setattr(common, "PARTS", 2)
    counts = spark.createDataFrame([(k, 60 if k < 3 else 20) for k in range(20)], "key long, n long")
    hot, limit = common.hot_keys(counts)
    assert limit == 50 and hot.count() == 3
    monkeypatch.setattr(common, "FEW", 2)
    hot, limit = common.hot_keys(counts)
    assert limit == 260 and hot is None


def test_every_pair_within_the_distance_shares_a_key():
    r = np.random.default_rng(3)
    for m, similarity in ((40, 0.85), (40, 0.8), (24, 0.9)):
        errors = minhash.max_errors(m, similarity)
        chunks, free = minhash.layout(m, errors)
        assert sorted(s for c in chunks for s in c) == list(range(m))
        for _ in range(300):
            wrong = set(r.choice(m, errors, replace=False).tolist())
            assert any(len(wrong & set(c)) <= min(free, len(c) - 1) for c in chunks)


def test_components(spark):
    r = random.Random(2)
    edges = [
        (r.randrange(300), r.randrange(300)) for _ in range(220)
    ] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    got = {x.node: x.component for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    pairs = {(a, b) for a, b in edges if a is not None and a != b}
    want = brute.components({n for p in pairs for n in p}, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    assert got == want


def test_hot_keys_join_as_others(spark, monkeypatch):
    r = random.Random(4)
    rows = [
        (r.choice([1, 1, 1, 2, 3, r.randrange(50)]), r.randrange(2), i) for i in range(400)
    ] + [(None, 0, 500), (7777, 1, 501)]
    left = spark.createDataFrame(rows, "k long, k2 int, i long")
    counts = left.groupBy("k", "k2").agg(F.count("*").alias("n"), F.min("i").alias("first")).where("n > 1")
    one = left.groupBy("k").agg(F.count("*").alias("n"))
    want = sorted(map(tuple, left.join(counts, ["k", "k2"]).collect()))
    pairs = left.select(F.col("k"), F.col("i").alias("j")).where("j < 60")
    both = sorted(map(tuple, left.join(pairs, "k").collect()))
    for least in (1000, 3):
        monkeypatch.setattr(common, "LEAST", least)
        assert sorted(map(tuple, common.look_up(left, counts, ["k", "k2"], ["i"]).collect())) == want
        assert sorted(map(tuple, common.even_join(left, pairs, "k", ["i"], one).collect())) == both


def test_groups_that_the_least_member_does_not_connect(spark):
    """Chains of near-copies, each like its neighbours only: links beyond the first member's, in one bucket or several."""
    r = random.Random(31)
    words, rows = [f"w{i}" for i in range(5000)], []
    for chain in range(3):
        w = r.sample(words, 300)
        for i in range(25):
            rows.append((r.randrange(10**6) * 3 + chain, " ".join(w)))
            for _ in range(3):
                w[r.randrange(len(w))] = f"x{r.random()}"
    got = {
        x.doc_id: (x.n_shingles, x.component_id) for x in minhash.near_duplicates(frame(spark, rows), block=4).collect()
    }
    assert got == brute.near_duplicates(rows)


def test_substrings(spark, rows, least_hot):
    rows = [*rows, (None, rows[60][1]), (5, rows[5][1])]
    got = substrings.remove_repeats(frame(spark, rows)).select("row.doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.substrings(rows), key=str)
    assert substrings.remove_repeats(frame(spark, rows[:0])).count() == 0


def test_windows_of_another_document_than_the_leader(spark):
    """Two documents share a run whose anchor a third, smaller one has in other surroundings."""
    w = [f"w{i}" for i in range(400)]
    rows = [
        (1, " ".join(w[100:125])),
        (2, " ".join(w[80:160])),
        (3, " ".join(w[90:150])),
        (4, " ".join(w[100:148] + ["z"] * 30)),
        (5, " ".join(["q"] * 5 + w[98:148] + ["z"] * 30)),
    ]
    got = substrings.remove_repeats(frame(spark, rows)).select("row.doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(brute.substrings(rows))


@pytest.mark.parametrize("way", ["plain", "many ranges", "large groups"])
def test_repeated_bytes(spark, rows, way, monkeypatch):
    if way != "plain":
        monkeypatch.setattr(common, "LEAST", 2)
    if way == "many ranges":  # which cut groups, and classes of equal suffixes
        monkeypatch.setattr(suffixes, "RANGE_BLOCKS", 1)
        monkeypatch.setattr(suffixes, "BLOCK_ENTRIES", 4)
    if way == "large groups":
        monkeypatch.setattr(suffixes, "GROUP", 3)
    r = random.Random(6)
    noise = lambda n: "".join(r.choices("abcdefgh ", k=n))
    passage = noise(700)
    rows = [
        *rows,
        (None, rows[60][1]),
        (5, rows[5][1]),
        *[
            (
                700 + i, noise(r.randint(100, 300)) + passage[r.randrange(60) :] + noise(r.randint(0, 300))
            ) for i in range(25)
        ],
    ]
    got = suffixes.remove_repeats(frame(spark, rows)).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", "kept"
    ).collect()
    assert sorted(
        ((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got), key=str
    ) == sorted(brute.repeated_bytes(rows), key=str)
    if way == "plain":
        assert suffixes.remove_repeats(frame(spark, rows[:0])).count() == 0


@pytest.mark.parametrize(
    "cuts", [[], [b"ab\xff", b"abab"], [b"aaaaa", b"b"], [b"abab\xffb", b"ababab", b"abababab\xffa", b"babb"]]
)
@pytest.mark.parametrize("most", [0, 3, 256])
def test_merged_parts_find_all_repeats(cuts, most):
    """Over a small alphabet, strings of 8 and seeds of 3: what is not found at once stands at an anchor that is asked later."""
    r = random.Random(11)
    length, seed = 8, 3
    texts = ["".join(r.choices("ab", k=r.randint(0, 30))).encode() for _ in range(30)]
    places = [(d, a) for d, t in enumerate(texts) for a in range(len(t) - seed + 1)]
    parts, members = {}, {}
    for k in range(3):
        own = places[k::3]
        of, entries = suffixes.sorted_run([suffixes.key_of(texts[d], a, length, length - seed) for d, a in own])
        for i in range(0, len(entries), 4):
            for part, e, block in suffixes.cut_block(suffixes.pack(entries[i : i + 4]), i, 0, len(cuts), cuts):
                parts.setdefault(part, {}).setdefault(k, []).append((e, block))
        for p, e in zip(own, of, strict=True):
            members.setdefault((k, e), []).append(p)
    edges = [None, *cuts, None]
    got, loose = set(), set()
    for part, runs in sorted(parts.items()):
        *found, ends = suffixes.merge_part(runs, edges[part], edges[part + 1], length, seed, most)
        keys = sorted(e[1] for own in runs.values() for _, b in own for e in suffixes.unpack(b))
        assert (ends[0], ends[1]) == (keys[0], keys[-1]) and all(
            (edges[part] or b"") <= x and x < (edges[part + 1] or b"\xff") for x in keys
        )
        known = [k.split(b"\xff")[0] for k in keys]
        assert ends[2] == next((x for x in known if x != known[0]), None) and ends[3] == next(
            (x for x in known[::-1] if x != known[-1]), None
        )
        for run, entry, size, c, r2, low, high in found:
            for d, a in members[run, entry]:
                if c + size >= length:
                    got.update((d, i) for i in range(a - c, a + size))
                if r2 >= seed or low or high:
                    loose.add((d, a))
    seen = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((d, i))
    want = {(d, j) for own in seen.values() if len(own) > 1 for d, i in own for j in range(i, i + length)}
    assert got <= want
    assert all(any((d, a) in loose for a in range(max(0, j - length), j + length)) for d, j in want - got)
    if most == 256 and not cuts:
        assert got == want


def test_loser_tree_merges_and_knows_prefixes():
    r = random.Random(4)
    for k in (0, 1, 2, 3, 7):
        runs = [
            sorted(
                "".join(r.choices("ab", k=r.randint(0, 6))).encode() for _ in range(r.randint(0, 30))
            ) for _ in range(k)
        ]
        entries = [[(suffixes.common(run[i - 1], s, 0) if i else 0, s) for i, s in enumerate(run)] for run in runs]
        out = [(known, e[1]) for known, _, e in suffixes.LoserTree([iter(e) for e in entries])]
        want = sorted(s for run in runs for s in run)
        assert [s for _, s in out] == want
        assert [n for n, _ in out] == [suffixes.common(want[i - 1], s, 0) if i else 0 for i, s in enumerate(want)]


def test_blocks_round_trip():
    entries = [(0, b"abcd\xffleft", 2), (3, b"abc\xff", 1), (1, b"ax\xffb", 1)]
    assert suffixes.unpack(suffixes.pack(entries)) == entries
    cuts = [b"", b"", b"abce", b"ad"]
    assert [
        (k, e, suffixes.unpack(b)) for k, e, b in suffixes.cut_block(suffixes.pack(entries), 10, 2, 4, cuts)
    ] == [(2, 10, entries[:1]), (3, 11, entries[1:2]), (4, 12, entries[2:])]


def test_embeddings(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(30, 32))
    x = np.concatenate(
        [centres[r.integers(0, 30, 260)] + r.normal(size=(260, 32)) * 0.08, r.normal(size=(200, 32))]
    ).astype(np.float32)
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [
        (1000, x[0].tolist()),
        (1001, x[0].tolist()),
        (1002, (x[0] * 3).tolist()),
        (1003, None),
        (1004, []),
        (1005, [0.0] * 32),
        (1006, [float("nan")] * 32),
        (1007, [None] * 32),
        (1008, [float("inf")] * 32),
        (None, x[0].tolist()),
    ]
    got = {
        q.vec_id: (q.n_links, q.component_id, q.kept)
        for q in embeddings.near_duplicates(
            spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")),
            block=40,
        ).collect()
    }
    good = [i for i, v in data if i is not None and i < 1003]
    m = np.array([v for i, v in data if i is not None and i < 1003], np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.95
    np.fill_diagonal(near, False)
    assert sum(got[i][0] for i in good) >= 0.9 * near.sum() and all(
        got[i][0] <= n for i, n in zip(good, near.sum(1), strict=True)
    )
    want = brute.components(range(len(good)), lambda a, b: near[a, b])
    assert np.mean([got[good[a]][1] == good[c] for a, c in want.items()]) > 0.98
    assert all(got[i] == (0, i, True) for i in (1003, 1004, 1005, 1006, 1007, 1008)) and got[None][0] == 0
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_scans_of_long_texts_are_linear():
    """5 MB of hits each: segments, suppression and spans equal their plain versions on short texts, and end soon."""
    r = random.Random(8)
    for _ in range(300):
        scores = np.array([r.choice([-2, -1, -0.5, 0.5, 1, 2]) for _ in range(r.randint(1, 40))])
        sums = np.concatenate([[0.0], np.cumsum(scores)])
        found = []  # the plain version: every stretch that no longer one of a higher sum holds
        for i in np.flatnonzero(scores > 0).tolist():
            low, high, start = sums[i], sums[i + 1], i
            while True:
                j = next((k for k in range(len(found) - 1, -1, -1) if found[k][0] < low), -1)
                if j < 0 or found[j][1] >= high:
                    break
                low, start = found[j][0], found[j][2]
                del found[j:]
            found.append((low, high, start, i + 1))
        assert toxicity.segments(sums, np.flatnonzero(scores > 0)) == [(a, b, y - x) for x, y, a, b in found]
        spans = sorted((a, "hex", a + r.randint(1, 9), "") for a in (r.randrange(60) for _ in range(r.randint(0, 9))))
        taken = secrets.Taken(spans)
        for a in range(60):
            b = a + r.randint(1, 6)
            assert taken.free(a, b) is not any(x < b and a < y for x, _, y, _ in spans)
    rules = licenses.make_rules()
    by = licenses.prefilter(rules)
    for text in (b"all rights reserved under the mit license, apache license version 2.0 ", b"licensed under cc by nc 4.0; "):
        low, kept = text * 5, []
        found = licenses.detect(low, rules, by)
        for k in sorted({k for w in by.keys() & set(licenses.ANY_WORD.findall(low)) for k, own in by[w] if own <= set(licenses.ANY_WORD.findall(low))}):
            for m in rules[k].pattern.finditer(low):
                if not any(a <= m.start() and m.end() <= b for a, b, _, _ in kept):
                    kept.append((m.start(), m.end(), rules[k].label, rules[k].confidence))
        assert found == kept
    began = time.process_time()
    falling = np.where(np.arange(800_000) % 2 == 0, 0.5, -0.51)
    assert len(toxicity.segments(np.concatenate([[0.0], np.cumsum(falling)]), np.flatnonzero(falling > 0))) == 400_000
    assert licenses.detect(b"all rights reserved " * 250_000, rules, by)
    base = secrets.base_spans("token=abcdef12345 " * 280_000)
    taken = secrets.Taken(base)
    assert not any(taken.free(a + 1, a + 3) for a, _, _, _ in base)
    long = ["".join(r.choices("0f", k=20_000)) for _ in range(64)]
    assert secrets.infer(sorted(long))
    assert time.process_time() - began < 40


@pytest.mark.parametrize("share, most", [(0.5, 600), (0.8, 3000)])
def test_vectors_that_share_a_direction(share, most):
    """Mean cosines of 0.5 and 0.8: centred codes bring close pairs together, and few others."""
    r = np.random.default_rng(3)
    n, dim = 12_000, 64
    common_ = embeddings.unit(r.normal(size=(1, dim)))
    x = embeddings.unit(np.sqrt(1 - share) * embeddings.unit(r.normal(size=(n, dim))) + np.sqrt(share) * common_)
    aside = r.normal(size=(3000, dim))
    aside = embeddings.unit(aside - (aside * x[:3000]).sum(1, keepdims=True) * x[:3000])
    tables, length, shift = embeddings.layout(51_282, x, 0.95)
    turn = embeddings.hyperplanes(embeddings.centred(x[:4000], shift), tables, length)
    codes = lambda v: (v @ turn >= shift @ turn).reshape(len(v), tables, length) @ (1 << np.arange(length))
    own = codes(x)
    met = (own[:3000] == codes(0.951 * x[:3000] + np.sqrt(1 - 0.951**2) * aside)).any(1)
    assert met.mean() > 0.95
    pairs = sum((np.bincount(own[:, k]).astype(float) ** 2).sum() for k in range(tables)) / n - tables
    assert pairs * 51_282 / n < most  # for the number of vectors that the layout is for


def close_pairs(n, dim, r):
    """2 n vectors; those at k and n + k have a cosine of 0.951 to 0.97, all others are far apart."""
    a, b = r.normal(size=(2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= a * (a * b).sum(1, keepdims=True)
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = np.linspace(0.951, 0.97, n)[:, None]
    return np.concatenate([a, c * a + np.sqrt(1 - c * c) * b])


@pytest.mark.parametrize("n, dim", [(1_000, 24), (51_282, 64), (400_000, 64), (50_000_000, 100)])
def test_close_vectors_meet_whatever_the_number(n, dim):
    x = close_pairs(3000, dim, np.random.default_rng(n + dim))
    tables, length, shift = embeddings.layout(n, x, 0.95)
    turn = embeddings.hyperplanes(embeddings.centred(x, shift), tables, length)
    bit = (x @ turn >= shift @ turn).reshape(len(x), -1, length)
    assert (bit[:3000] == bit[3000:]).all(2).any(1).mean() > 0.98


@pytest.mark.parametrize("n", [50_000_000])
def test_embeddings_in_the_layout_of_a_large_table(spark, n, monkeypatch):
    of = embeddings.layout
    monkeypatch.setattr(embeddings, "layout", lambda _, x, least: of(n, x, least))
    x = close_pairs(400, 64, np.random.default_rng(n))
    got = {
        q.vec_id: q.n_links for q in embeddings.near_duplicates(
            spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        ).collect()
    }
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    assert sum(got.values()) >= 0.97 * near.sum() and all(got[i] <= k for i, k in enumerate(near.sum(1)))


@pytest.mark.parametrize("scale", [1e-170, 1e170])
def test_embeddings_of_extreme_lengths(spark, scale):
    rows = [
        (1, [3.0, 4.0, 0.0]), (2, [3.0 * scale, 4.0 * scale, 0.0]), (3, [0.0, scale, -scale]), (4, [0.0, -1.0, 1.0])
    ]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)]


def test_embeddings_that_all_fall_into_one_bucket(spark):
    """A bucket of many blocks: every pair is compared once."""
    r = np.random.default_rng(9)
    x = np.ones(8) + r.normal(size=(150, 8)) * 0.02
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=16
    ).collect()
    assert len(got) == 150 and all(g.n_links == 149 and g.component_id == 0 for g in got)


def test_candidate_pairs():
    at, lo, hi = np.array([0, 0, 0, 1, 0, 1, 0]), np.array([0, 0, 0, 0, 0, 0, 2]), np.array([0, 0, 1, 1, 1, 1, 2])
    for most in (1, 2, 100):
        pairs = [
            (int(a), int(b))
            for i, j in embeddings.candidates(np.array([0, 2, 6, 7]), at, lo, hi, most)
            for a, b in zip(i, j, strict=True)
        ]
        assert pairs == [(0, 1), (2, 3), (2, 5), (3, 4), (4, 5)]


def test_embeddings_of_few_vectors(spark):
    got = embeddings.near_duplicates(
        spark.createDataFrame(
            [(2, [1.0, 0.0]), (1, [1.0, 0.01]), (3, [0.0, 1.0]), (4, [1.0])], "vec_id long, embedding array<double>"
        )
    ).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)]


def test_licenses(spark):
    texts = [
        "Licensed UNDER the (MIT) License. Under the mit license",
        "Apache License, Version 2.0 and CC BY-NC 4.0",
        "xunder the mit license",
        "SPDX-License-Identifier: GPL-3.0",
        "released under the GNU General Public License v3",
        None,
        "",
        "under the é mit license",
        "All rights reserved",
        "word " * 50000,
    ]
    got = {
        r[0]: r
        for r in licenses.scan(frame(spark, list(enumerate(texts)))).select(
            "row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
        ).collect()
    }
    assert got[0][1:6] == (9, 2, 1, 5, "mit") and got[1].base_labels == "apache-2,cc-by-nc" and got[1].n_base == 2
    assert got[
        2
    ].n_base == 0 and got[2].first_word is None and "gpl-3.0" in got[3].labels and "gpl-3.0" in got[4].labels
    assert got[5][1:] == (
        0, 0, None, None, "", "", 0.0
    ) == got[6][1:] and got[7].n_base == 0 and got[8].labels == "proprietary" and got[9].n_words == 50000
    assert all(0 <= r.score <= 1 for r in got.values()) and len(licenses.make_rules()) > 200
    assert licenses.scan(frame(spark, [])).count() == 0


def test_base_phrases_equal_brute_force(spark):
    r = random.Random(17)
    bits = ["Under", "the", "MIT", "license", "Apache", "version", "2", "cc", "by", "nc", "é", "underé", "x"]
    texts = [
        "".join(
            r.choice(bits) + r.choice([" ", "-", "\n", ", ", ""]) for _ in range(r.randint(0, 120))
        ) for _ in range(200)
    ]
    texts += ["cc by nc " * 3000, None, "", "under the mit license", "cc by cc by nc by nc"]
    got = licenses.scan(frame(spark, list(enumerate(texts)))).select(
        "row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"
    ).collect()
    assert sorted(tuple(x)[:6] for x in got) == [(i, *brute.license_phrases(t)) for i, t in enumerate(texts)]
    assert all(set(filter(None, x.base_labels.split(","))) <= set(x.labels.split(",")) for x in got)


def examples(parsed):
    """Strings that the parsed expression matches: each alternative, optional parts left out, white space as a line break."""
    from re import _parser as p

    out = [b""]
    for op, arg in parsed:
        more = [b""]
        if op is p.LITERAL:
            more = [bytes([arg])]
        elif op is p.SUBPATTERN:
            more = examples(arg[3])
        elif op is p.BRANCH:
            more = [x for own in arg[1] for x in examples(own)]
        elif op is p.MAX_REPEAT and arg[0]:
            more = examples(arg[2])
        elif op is p.IN:
            more = [b"\n"] if arg[0][0] is p.NEGATE else [bytes([v if k is p.LITERAL else v[0]]) for k, v in arg]
        elif op is p.AT:
            more = [b" "]
        out = [a + b for a in out for b in more]
    return out


def test_license_filter_loses_no_alternative():
    from re import _parser as p

    rules = licenses.make_rules()
    assert len(rules) > 250 and all(r.keywords and all(r.keywords) for r in rules)
    by = licenses.prefilter(rules)
    for rule in rules:
        some = examples(p.parse(rule.pattern.pattern))
        for text in some[:: max(1, len(some) // 200)]:
            assert rule.pattern.search(text)
            assert any(k <= set(licenses.ANY_WORD.findall(text)) for k in rule.keywords)
    for rule in rules:
        text = examples(p.parse(rule.pattern.pattern))[-1]
        kept = []
        for other in rules:
            kept += [
                (m.start(), m.end(), other.label, other.confidence) for m in other.pattern.finditer(text)
                if not any(a <= m.start() and m.end() <= b for a, b, _, _ in kept)
            ]
        assert licenses.detect(text, rules, by) == kept != []


@pytest.mark.parametrize(
    "text, label",
    [
        ("released under the GPL v3", "gpl-3.0"),
        ("distributed under MPL 2.0", "mpl-2.0"),
        ("see the MIT terms", "mit"),
        ("it is in the public\ndomain", "public-domain"),
        ("all rights\nreserved", "proprietary"),
        ("available under\nzlib", "zlib"),
        ("licensed under the GNU Lesser General Public License version 2.1", "lgpl-2.1"),
        ("licensed under the GNU Affero General Public License version 3", "agpl-3.0"),
        ("licensed under the GNU Free Documentation License 1.3", "gfdl-1.3"),
        ("published under Open Data Commons Attribution", "odc-by-1.0"),
        ("published under the Public Domain Dedication and Licence", "pddl-1.0"),
        ("published under the open  government licence", "ogl-3.0"),
        (
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software\nand associated documentation files",
            "mit",
        ),
        ("Redistribution and use in source and binary forms, with or\n * without modification, are permitted", "bsd"),
        ("see GPL 3 terms", "gpl-3.0"),
        ("available under Apache 2.0", "apache-2"),
        ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa-4.0"),
        (
            "Neither the name of the University of Somewhere nor the names of its contributors may be used to endorse or promote products",
            "bsd-3-clause",
        ),
    ],
)
def test_licenses_in_other_words(text, label):
    rules = licenses.make_rules()
    assert label in [x[2] for x in licenses.detect(text.lower().encode(), rules, licenses.prefilter(rules))]


def test_contained_detections_of_lower_priority_are_suppressed():
    rules = licenses.make_rules()
    found = licenses.detect(b"licensed under the apache license, version 2.0", rules, licenses.prefilter(rules))
    assert [x[2] for x in found] == ["apache-2"]


def test_secrets(spark):
    r = random.Random(5)
    hexes = ["".join(r.choices("0123456789abcdef", k=40)) for _ in range(60)]
    keys = ["AKIA" + "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)) for _ in range(60)]
    texts = [
        f"é {'Api_Key' if i % 2 else 'TOKEN'} = \"{h}\" and {k}"
        for i, (h, k) in enumerate(zip(hexes, keys, strict=True))
    ]
    texts += [
        "password: short",
        "x ASIA" + keys[0][4:] + " y",
        "token: token: abcdefgh",
        None,
        "",
        "plain release-notes-2024-for-version-two words",
        "a1" * 60000,
    ]
    out = secrets.find(frame(spark, list(enumerate(texts)))).select("row.doc_id", "base", "spans").collect()
    got = {x.doc_id: x for x in out}
    assert [(s.kind, s.start, s.end) for s in got[0].base] == [
        ("assign", 2, 2 + len(f'TOKEN = "{hexes[0]}')), ("hex", 11, 51), ("access", 57, 77)
    ]
    assert got[60].base == [] and got[62].base == [] and got[63].spans == [] and got[64].spans == []
    assert [(s.kind, s.start, s.end) for s in got[61].spans] == [("format", 2, 22)] and got[65].spans == []
    assert all({(s.start, s.kind) for s in x.base} <= {(s.start, s.kind) for s in x.spans} for x in out)
    assert secrets.find(frame(spark, [])).count() == 0


def test_secrets_are_scored_whole_and_of_any_labelled_form(spark):
    r = random.Random(12)
    short = lambda: "".join(r.choices("0123456789", k=4)) + "." + "".join(r.choices("0123456789", k=6))
    hexes = ["".join(r.choices("0123456789abcdef", k=40)) for _ in range(60)]
    words = ["".join(r.choices("eastrnoidlu", k=r.randint(4, 11))) for _ in range(3000)]
    texts = [f"{' '.join(r.choices(words, k=20))} token: {short()} {h}" for h in hexes]
    texts += [
        f"an {short()} b",
        f"It is {short()}.",
        "zz-" + "z-" * 40 + "z",
        f"{hexes[0].upper()[:20]}{'+/zq-_' * 40}",
        " ".join(words[:300]),
        hexes[1][:12] + "/" * 3000,
    ]
    got = {
        x.doc_id: x.spans
        for x in secrets.find(frame(spark, list(enumerate(texts)))).select("row.doc_id", "spans").collect()
    }
    assert [(s.kind, s.start, s.end) for s in got[60]] == [("format", 3, 14)]
    assert any(s.kind == "format" and s.start == 6 and s.end >= 17 for s in got[61])
    assert [s for k in (62, 63, 64, 65) for s in got[k]] == []
    assert not any(s.kind == "format" for k in range(60) for s in got[k])


def test_secrets_of_the_fixed_patterns_equal_brute_force(spark):
    r = random.Random(3)
    bits = [
        "password",
        "PassWD",
        "tokens",
        "Api_Key",
        "APIKEY",
        "secret",
        " ",
        " = ",
        ":",
        "=",
        '"',
        "'",
        "AKIA",
        "ABCDEFGH23456789",
        "0123456789abcdef",
        "deadbeef",
        "xyz",
        ".",
        "-",
        "é",
        "漢",
        "ſecret",
        "toKen",
        "\n",
    ]
    texts = ["".join(r.choices(bits, k=r.randint(0, 40))) for _ in range(400)] + [None, "", "AKIA" * 30, "a" * 100_000]
    out = secrets.find(frame(spark, list(enumerate(texts)))).select("row.doc_id", "base", "spans").collect()
    assert len(out) == len(texts)
    for x in out:
        assert [(s.kind, s.start, s.end) for s in x.base] == brute.secrets(texts[x.doc_id])
        assert {tuple(s) for s in x.base} <= {tuple(s) for s in x.spans}
        assert all(s.kind != "format" or not any(b.start < s.end and s.start < b.end for b in x.base) for s in x.spans)


@pytest.mark.parametrize("seed", range(100))
def test_automata_of_mixed_formats_hold_every_word(seed):
    """Every word has a path, probabilities add up to one, and they are those counted along the paths."""
    r = random.Random(seed)
    forms = [
        "0123456789abcdef",
        "ABCDEFGHIJ0123456789",
        "abcxyz0123-",
        "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMN0123456789+/_.=-",
    ]
    words = sorted(secrets.classes("".join(r.choices(forms[r.randrange(4)], k=r.randint(6, 60)))) for _ in range(512))
    automaton = secrets.infer(words)
    seen = [{} for _ in automaton]
    for w in words:
        at = 0
        for c in (*w, ""):
            seen[at][c] = seen[at].get(c, 0) + 1
            at = automaton[at][1][c][1] if c else at
    for own, (end, steps) in zip(seen, automaton, strict=True):
        total = sum(own.values()) + 0.5 * (len(steps) + 1)
        assert end == pytest.approx((own.get("", 0) + 0.5) / total) and set(own) <= {"", *steps}
        assert all(p == pytest.approx((own.get(c, 0) + 0.5) / total) for c, (p, _) in steps.items())
        assert end + sum(p for p, _ in steps.values()) == pytest.approx(1)


def test_candidates_are_runs_then_cores_then_pieces():
    runs = secrets.Runs.of(pa.array(["é abc.defghi=", None, "漢short ==abcdef", "abcdefgh"]))
    got = [(int(t), int(at), runs.read(runs.data, i)) for i, (t, at) in enumerate(zip(runs.text, runs.at, strict=True))]
    assert got == [(0, 2, "abc.defghi="), (2, 7, "==abcdef"), (3, 0, "abcdefgh")]
    assert secrets.parts_of("abc.defghi=") == [
        (0, 11), (0, 10), (4, 10)
    ] and secrets.parts_of("==abcdef") == [(0, 8), (2, 8)]


def test_automata_compare_states_to_the_full_depth():
    body = "0f" * 40
    words = [a + body + b * 8 for a, b in (("f", "Z"), ("0", "z")) for _ in range(300)]
    a = secrets.infer(words)
    assert secrets.likelihood(a, "f" + body + "Z" * 8) > secrets.likelihood(a, "f" + body + "z" * 8) + 4
    assert len(secrets.classes("a" * 500)) == 500


def test_automata_tell_formats_apart():
    r = random.Random(6)
    hexes = ["".join(r.choices("0123456789abcdef", k=40)) for _ in range(200)]
    automata, background = secrets.learn({"hex": hexes}, ["release-notes-of-2024"] * 50)
    (_, a, least) = automata[0]
    fresh = ["".join(r.choices("0123456789abcdef", k=40)) for _ in range(100)]
    assert np.mean([secrets.odds(a, background, secrets.classes(w)) >= least for w in fresh]) > 0.8
    assert not any(
        secrets.odds(a, background, secrets.classes(w)) >= least
        for w in ("release-notes-of-2023-a", "Some-Path/To-9-Things")
    )


def test_decontamination(spark, rows):
    r = random.Random(7)
    items = [
        (i, " ".join(f"b{r.randrange(10**6)}" for _ in range(n))) for i, n in enumerate((40, 60, 18, 6, 3, 30))
    ] + [(50, None), (51, ""), (None, "x y z " * 9)]
    hide = lambda text, share: " ".join(w if r.random() > share else f"s{r.random()}" for w in text.split())
    clean = [(i, t) for i, t in rows if i != 406]
    dirty = [
        (500, f"{rows[1][1]} {items[0][1].upper()} {rows[2][1]}"),
        (501, hide(items[1][1], 0.1)),
        (502, f"a, {items[2][1]}!"),
        (503, f"z {items[3][1]} z"),
        (504, " ".join(items[5][1].split()[:22])),
        (505, items[0][1] + " " + items[1][1]),
    ]
    found = decontam.contamination(
        frame(spark, clean + dirty),
        spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0)),
    )
    got = {(x.doc_id, x.item_id) for x in found.collect()}
    assert got == {(500, 0), (501, 1), (502, 2), (503, 3), (504, 5), (505, 0), (505, 1)}
    unfiltered = decontam.contamination(
        frame(spark, clean[:10] + dirty), spark.createDataFrame(items, "item_id long, text string"), max_filter=0
    )
    assert {(x.doc_id, x.item_id) for x in unfiltered.collect()} == got
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(frame(spark, clean[:3]), none).count() == 0
    assert sorted(
        x.doc_id for x in decontam.drop_contaminated(
            frame(spark, clean[:3] + dirty[:1]), spark.createDataFrame(items, "item_id long, text string")
        ).collect()
    ) == sorted(i for i, _ in clean[:3])


@pytest.mark.parametrize("n", range(5, 24))
def test_masks_find_every_placing_of_substitutions(n):
    """Of n tokens of an item (20 of a longer one), for every choice of the tokens that may be substituted."""
    from itertools import combinations

    w = min(n, decontam.WINDOW)
    own = decontam.MASKS[max(k for k in decontam.MASKS if k <= n)]
    held = [sum(1 << (at + j) for j, x in enumerate(m) if x == "1") for m in own for at in range(w - len(m) + 1)]
    for wrong in combinations(range(w), w - -(-w * decontam.PERCENT // 100)):
        gone = sum(1 << x for x in wrong)
        assert any(not gone & h for h in held)


@pytest.mark.parametrize("max_filter", [0, 1 << 21])
def test_decontamination_equals_brute_force(spark, max_filter):
    r = random.Random(21)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [
        (k, " ".join(r.choices(vocabulary, k=n))) for k, n in enumerate([*range(3, 26), 40, 60])
    ] + [(90, None), (91, ""), (None, "v1 " * 9)]
    rows = []
    for i in range(300):
        words = r.choices(vocabulary, k=r.randint(0, 60))
        own = r.choice(items[:25])[1].split()
        a = r.randrange(len(own))
        part = own if r.random() < 0.6 else own[a : a + r.randint(4, 30)]
        wrong = r.sample(range(len(part)), min(len(part), r.randint(0, 1 + len(part) // 4)))
        at = r.randint(0, len(words))
        rows.append(
            (
                i,
                " ".join(
                    [*words[:at], *["other" if j in wrong else w.upper() for j, w in enumerate(part)], *words[at:]]
                ),
            )
        )
    rows += [(400, None), (401, ""), (None, items[20][1])]
    found = decontam.contamination(
        frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), max_filter=max_filter
    ).collect()
    want = brute.contaminated(rows, items)
    assert len(want) > 100 and {(x.doc_id, x.item_id) for x in found} == want and len(found) == len(want)


def labelled(n=600):
    r = random.Random(8)
    plain, bad = [f"w{i}" for i in range(300)], ["vile", "nasty", "awful"]
    rows, labels = [], []
    for i in range(n):
        w = r.choices(plain, k=r.randint(5, 120))
        toxic = r.random() < 0.3
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = labelled()
    truth = {i: y for i, _, y in labels}
    edge = [(9000, None), (9001, ""), (9002, "vile " * 20000), (None, "nasty vile awful things"), (3, rows[3][1])]
    y = spark.createDataFrame(
        [*labels, (3, 1, 0), (None, 1, 1), (7, 1, None), (8888, 0, 1)], "doc_id long, quality int, toxic int"
    )
    docs = frame(spark, rows + edge)
    model = toxicity.fit(docs, y)
    out = toxicity.score(docs, model).select("row.doc_id", "score", "segments", "best_start", "best_end").collect()
    assert any(len(r.segments) > 0 for r in out) and all(r.best_start <= r.best_end for r in out)
    got = {r.doc_id: r.score for r in out}
    held = [i for i in truth if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert len(out) == len(rows) + len(edge) and all(0 <= r.score <= 1 for r in out)
    assert np.mean([(got[i] >= 0.5) == truth[i] for i in held]) > 0.95
    assert got[9000] == got[9001] < 0.5 <= got[9002] and got[None] >= 0.5
    flipped = [(i, q, 1 - t if __import__("zlib").crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    again = toxicity.fit(docs, spark.createDataFrame([*flipped, (3, 1, 0)], "doc_id long, quality int, toxic int"))
    assert np.array_equal(again.tokens, model.tokens) and again.slope == pytest.approx(model.slope)


def test_toxicity_without_labels(spark):
    docs = frame(spark, labelled(20)[0])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), none)).count() == 0


def test_maximal_segments():
    def plain(scores):
        """Ruzzo and Tompa's definition, by recursion on the best segment."""
        best = max(
            ((sum(scores[a:b]), -(b - a), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
            default=None,
        )
        if not best or best[0] <= 0:
            return []
        a, b = best[2], best[3]
        return plain(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in plain(scores[b:])]

    r = random.Random(9)
    for _ in range(200):
        s = [r.choice([-3, -2, -1, 1, 2, 3]) + r.random() / 1000 for _ in range(r.randint(0, 12))]
        sums = np.concatenate([[0.0], np.cumsum(s)])
        assert [(a, b) for a, b, _ in toxicity.segments(sums, np.flatnonzero(np.array(s) > 0))] == plain(s)


def test_bytes_and_windows():
    r = np.random.default_rng(1)
    x = r.integers(0, 50, 200).astype(np.uint64)
    for w in (1, 3, 17):
        assert common.sliding_min(x, w).tolist() == [int(x[i : i + w].min()) for i in range(len(x) - w + 1)]
    assert hashlib.sha256(b"").hexdigest() == brute.sha("")
