"""Ranked search, packing and alignment against plain versions, on rows with nulls, blanks, copies, ties, long texts and
clashing names."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from landloom.llm import alignment, packing, search

public = pytest.importorskip("public_tokenizers")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [
    None, "", " ", "  \t\n ", "one", "one", "Two Words", " lead and trail  ", "the " * 3000, "ab" * 4000, "x" * 9001,
    "a▁b", "▁", "a ▁ b", "a▁ b", "a　 b", "a\u0085 b   c", "é è à ü漢字 漢 字", "don't we'll 've <|endoftext|> <s></s> <unk>",
    "<|startoftext|>x<|endoftext|> y", "\n\n  \n x\r\n\ty\x0b\x0c", "1234567890 12 3.14", "😀 👩‍👩‍👧 ﬁ Å Å İ Σς ΑΣ ", "\x00a\x01 b\x7f", "\x1c x\x1d\x1e y",
]


def corpus(n=300, seed=3):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeéß漢TH", k=r.randint(1, 7))) for _ in range(300)] + ["the", "of"] * 60
    out = [(i, " ".join(r.choices(words, k=r.randint(0, 300)))) for i in range(n)]
    out += [(1000 + i, out[7][1]) for i in range(80)]  # copies: ties
    out += [(2000 + i, t) for i, t in enumerate(AWKWARD)]
    out += [(None, "the one of"), (None, "the one of"), (5, "the five"), (3001, " ".join(r.choices(words, k=20000)))]
    return out, words, r


def frame(spark, rows):
    names = {"ids": F.lit("x"), "shard": F.lit(1), "near": F.lit(0), "term": F.lit("t"), "key": F.lit(2), "n": F.lit(None).cast("int")}
    made = spark.createDataFrame([(i, t, "en", None, 1) for i, t in rows], DOCS)
    return made.repartition(5).withColumns(names)


# ------------------------------------------------------------------------------------------------- search


def terms(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def plain_ranks(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c in held:
            n, score = sum(c.values()), 0
            for t in wanted & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 50 + (50 * n * n_docs) // n_terms
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, j + 1, x[3], -x[0]) for j, x in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("shard,stages,k", [(4096, 4, 50), (40, 3, 5), (150, 1, 60)])
def test_search(spark, monkeypatch, shard, stages, k):
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "BUNDLE", 4)
    docs, words, r = corpus()
    items = [(i, " ".join(r.choices(words, k=r.randint(1, 30)))) for i in range(18)]
    items += [(50, None), (51, ""), (52, "nowheretobefound"), (53, "THE one"), (54, docs[7][1]), (3, "also the"), (None, "of"), (None, "漢")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("local", F.lit(9)).repartition(3)
    got = search.ranked(frame(spark, docs), asked, k=k, stages=stages)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=key) == sorted(
        plain_ranks(docs, items, k), key=key
    )


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert search.ranked(docs, items).count() == 0
    assert search.ranked(frame(spark, [(1, "the")]), items.limit(0)).count() == 0
    assert search.ranked(frame(spark, [(1, None), (2, "")]), items).count() == 0


# ------------------------------------------------------------------------------------------------- packing


@pytest.mark.parametrize("shard", [1024, 9])
def test_packing_is_a_round_trip(spark, monkeypatch, shard):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "SHARD", shard)
    path = public.path("word_bpe_49k.json")
    docs, _, _ = corpus()
    pieces = packing.pack(frame(spark, docs), path, 2).collect()
    tool = Tokenizer.from_file(path)
    want = Counter((i, tuple([*tool.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in docs)

    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length > 0
        by_doc[p.doc_id].append((p.start, p.doc_tokens, tuple(ids.tolist())))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    once = {i: ids for (i, ids), n in want.items() if sum(m for (j, _), m in want.items() if j == i) == 1}
    for i, ids in once.items():
        parts = sorted(by_doc[i])
        assert [s for s, _, _ in parts] == np.cumsum([0, *[len(x) for _, _, x in parts[:-1]]]).tolist()
        assert sum((x for _, _, x in parts), ()) == ids and {n for _, n, _ in parts} == {len(ids)}
    assert sum(p.length for p in pieces) == sum(len(ids) * n for (_, ids), n in want.items())
    small = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0
        small += at < 4096
    assert small <= 12 * 8


def test_packing_of_awkward_tables(spark):
    path = public.path("word_bpe_49k.json")
    assert packing.pack(spark.createDataFrame([], DOCS), path, 2).count() == 0
    (p,) = packing.pack(frame(spark, [(None, None)]), path, 7).collect()
    assert (p.doc_id, p.start, p.length, p.doc_tokens, p.offset) == (None, 0, 1, 1, 0)
    assert zlib.crc32(p.ids) == zlib.crc32((7).to_bytes(4, "little"))
    with pytest.raises(ValueError):
        packing.pack(frame(spark, [(1, "a")]), path, 2, window=1000)


def test_scores_of_the_index():
    r = random.Random(5)
    docs = [np.array(r.choices(range(40), k=r.randint(1, 60)), np.uint32) for _ in range(30)]
    mean = sum(map(len, docs)) / len(docs)
    df = Counter(t for d in docs for t in set(d.tolist()))
    index = packing.Index(docs)
    for seed in range(len(docs)):
        want = []
        for d in docs:
            tf, score = Counter(d.tolist()), 0.0
            for t in set(docs[seed].tolist()) & set(tf):
                idf = math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5))
                score += idf * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(d) / mean))
            want.append(score)
        assert np.allclose(index.scores(seed), want)


def test_neighbours_share_a_window():
    """Two kinds of documents in turn: each window holds one kind, but for the last ones."""
    r = random.Random(1)
    kinds = [list(range(100, 400)), list(range(1000, 1300))]
    docs = [(i, np.array(r.choices(kinds[i % 2], k=60), np.uint32)) for i in range(400)]
    packer = packing.Packer(1024, 0)
    packer.shard(docs)
    packer.close()
    mixed = defaultdict(set)
    for doc, _, _, sequence, _ in packer.pieces:
        mixed[sequence].add(doc[0] % 2)
    assert sum(len(x) > 1 for x in mixed.values()) <= 2


# ------------------------------------------------------------------------------------------------- alignment


def plain_alignment(docs):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    byte_of = alignment._byte_of()
    rows, counts = [], Counter()
    for i, t in docs:
        raw = (" " + (t or "")).encode()
        ids_a, ids_b = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        bytes_a = [bytes(byte_of[c] for c in a.id_to_token(x)) for x in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids_b]
        groups = []
        if b"".join(bytes_a) == raw == b"".join(bytes_b):
            ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
            edges = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
            from_a = from_b = 0
            for e in edges:
                to_a, to_b = from_a, from_b
                while to_a < len(ends_a) and ends_a[to_a] <= e:
                    to_a += 1
                while to_b < len(ends_b) and ends_b[to_b] <= e:
                    to_b += 1
                groups.append((ids_a[from_a:to_a], ids_b[from_b:to_b]))
                from_a, from_b = to_a, to_b
        links = Counter()
        for x, y in groups:
            for (p, n), (q, m) in ((u, v) for u in Counter(x).items() for v in Counter(y).items()):
                links[p, q] += n * m
        counts.update(links.keys())
        rows.append((i, groups, links))
    best = Counter()
    for (p, _), n in counts.items():
        best[p] = max(best[p], n)
    return [
        (
            i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(links.values()),
            sum(n for k, n in links.items() if counts[k] == best[k[0]]), sum(n * counts[k] for k, n in links.items()),
            ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g),
        )
        for i, g, links in rows
    ]


@pytest.mark.parametrize("rounds", [1, 2])
def test_alignment(spark, monkeypatch, rounds):
    docs = corpus(n=60)[0][:-1]
    docs.append((3001, " ".join(f"w{k}é {'ab' * (k % 9)}漢" for k in range(1500))))
    if rounds > 1:
        monkeypatch.setattr(alignment, "SEGMENT", 2000)
        monkeypatch.setattr(alignment, "CHUNK", 64)
        monkeypatch.setattr(alignment, "HELD", 50)
        monkeypatch.setattr(alignment, "BLOCK", 4000)
        monkeypatch.setattr(alignment, "REMEMBERED", 200)
    group = 4000 if rounds > 1 else alignment.GROUP
    got = alignment.aligned(
        frame(spark, docs), public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model"), group=group
    )
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(plain_alignment(docs))


def test_alignment_of_empty_tables(spark):
    paths = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
    assert alignment.aligned(spark.createDataFrame([], DOCS), *paths).count() == 0
    rows = alignment.aligned(frame(spark, [(1, None), (2, ""), (3, "▁")]), *paths).collect()
    assert {tuple(r)[1:] for r in rows} == {(0, 0, 0, 0, 0, 0, "")}


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 62, n).astype(np.uint64))
    segments = 5
    own = alignment.segments_of(keys, segments)
    made = alignment.PerfectHash(segments, {s: alignment.build(keys[own == s]) for s in range(segments)})
    numbers = made.numbers(keys)
    assert sorted(numbers.tolist()) == list(range(len(keys)))
    assert (made.keys[numbers] == keys).all()
    assert (made.numbers(keys + np.uint64(1 << 62)) == -1).all()
    half = alignment.PerfectHash(segments, {s: alignment.build(keys[own == s]) for s in (1, 2)})
    inside = np.isin(own, (1, 2))
    assert (half.numbers(keys)[~inside] == -1).all()
    assert sorted(half.numbers(keys)[inside].tolist()) == list(range(int(inside.sum())))
