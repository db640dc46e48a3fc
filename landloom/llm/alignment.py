"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and in how many documents of the corpus
each pair of them does.

Pass one aligns all documents; each task sums the documents of each pair that it holds. The distinct pairs are dealt
into segments of some SEGMENT keys, and each gets a minimal perfect hash of its own (levels of bits, in which a key takes
the first level where it falls alone; its number is the rank of its bit). By these, the tasks' sums are added into dense
vectors of counts, and the vectors are added up as a tree. Pass two aligns the documents again and looks the counts up; a
key is verified against the key that has its number, so keys of other segments are told apart.

Hashes and counts of at most GROUP pairs are broadcast at a time; more pairs take more rounds, with the same result. The
number of pairs is bound by the vocabularies, not by the corpus.

Texts are cut at spaces and ends of lines where neither tokenizer can have a token that reaches across; a piece that
recurs is aligned once in a worker, told apart by a 64-bit hash."""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.common import blocks, forget, mixed, save, table, utf8
from landloom.llm.pieces import Store, distinct, ragged, read

#: Keys in a segment, in the segments that are broadcast together, counts in one row of a vector.
SEGMENT, GROUP, CHUNK = 1 << 16, 1 << 22, 1 << 16
#: Pieces of text of which a Python worker remembers the alignment; pairs that a task sums up before it passes them on.
REMEMBERED, HELD = 1 << 20, 1 << 21
BLOCK = 1 << 20
#: Pairs of a group beyond which it is counted by distinct ids.
LINKS = 1 << 12
#: Bits in a level for each key that is left.
ROOM = 2

# fixed value: how byte-level tokenizers of this kind split text before their merges
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes after which a space begins a new piece: visible ASCII, and ends of characters that are no white space in
#: any sense (those of U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000, and of U+2581,
#: which stands for a space, are left out; characters of two bytes are none of these from U+00C0 on).
BEFORE = np.zeros(256, bool)
BEFORE[0x21:0x7F] = True
BEFORE[0x80:] = True
BEFORE[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = False
#: What begins a new piece after those: a space, the end of a line. After the end of a line, visible ASCII and bytes that
#: begin no white space do too.
BREAK = np.zeros(256, bool)
BREAK[[0x20, 0x0A]] = True
AFTER = np.ones(256, bool)
AFTER[: 0x21] = AFTER[0x7F:0xC0] = AFTER[[0xC2, 0xE1, 0xE2, 0xE3]] = False


# ------------------------------------------------------------------------------------------------- aligning


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes for themselves, the others in
    turn for U+0100 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(how many each has, all values)."""
    return np.array([len(x) for x in lists], np.int64), np.fromiter(chain.from_iterable(lists), np.int64)


class Aligner:
    """Tokens of both tokenizers for pieces of text, aligned; columns of a store: figures (1 where the tokens spell the
    piece; tokens of a, of b, groups, links), keys of pairs, how often each is linked, groups as text."""

    def __init__(self, path_a: str, path_b: str):
        import json

        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["id"] for t in model["added_tokens"]}
        byte_of = _byte_of()
        # ids follow the order of merges, so they are ranks
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["model"]["vocab"].items() if i not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        of_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        if any("▁" in p.lstrip("▁") for p in pieces) or any("\n" in p for p in pieces):
            raise ValueError("pieces must reach neither from a word into the next nor over the end of a line")
        of_a = [b""] * (max(ranks.values(), default=0) + 1)
        for raw, i in ranks.items():
            of_a[i] = raw
        self.bytes_a, self.bytes_b = _table(of_a), _table(of_b)
        # a token's id with what stands before it: nothing at a piece's begin, else a semicolon, a comma, a bar
        most = max(len(of_a), len(of_b))
        self.names = _table([mark + b"%d" % i for mark in (b"", b";", b",", b"|") for i in range(most)])
        self.most = most
        self.line_a, self.line_b = self.a.encode_ordinary("\n"), self.b.encode("\n")[1:]
        self.store = Store((np.int64, np.uint64, np.int64, np.uint8), REMEMBERED)

    def tokens(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """(how many tokens each piece has, all of them) for a and b. Pieces of one word are encoded together, with
        ends of lines between, which no token crosses."""
        plain = [k for k, t in enumerate(texts) if t[:1] != "\n" and len(t.split()) == 1 and t[-1:].strip() and t[1:2].strip()]
        rest = sorted(set(range(len(texts))) - set(plain))
        out = []
        for line, encode, whole, lead in (
            (self.line_a, self.a.encode_ordinary, lambda some: [self.a.encode_ordinary(t) for t in some], 0),
            (self.line_b, self.b.encode, lambda some: [x[2:] for x in self.b.encode(["\n" + t for t in some], num_threads=1)], 1),
        ):
            sizes, parts = np.zeros(len(texts), np.int64), []
            for at in range(0, len(plain), 4096):
                own = plain[at : at + 4096]
                ids = np.array(encode("\n" + "\n".join([texts[k] for k in own]))[lead:], np.int64)
                edge = np.flatnonzero(ids == line[0])
                sizes[own] = np.diff(np.append(edge, len(ids))) - 1
                parts.append(ids[ids != line[0]])
            more, ids = _flat(whole([texts[k] for k in rest]))
            sizes[rest] = more
            order = np.argsort(np.array([*plain, *rest], np.int64), kind="stable")
            got = np.concatenate([np.zeros(0, np.int64), *parts, ids])
            edges = np.concatenate([[0], np.cumsum(sizes[[*plain, *rest]])])
            out.append((sizes, ragged(got, edges, order)[0]))
        return out[0], out[1]

    def make(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The columns of the store for pieces data[starts:ends]."""
        (size_a, a), (size_b, b) = self.tokens(read(data, starts, ends))
        raw, length = _spans_of(data, starts, ends)
        n = len(starts)
        piece_a, piece_b = np.repeat(np.arange(n), size_a), np.repeat(np.arange(n), size_b)
        (raw_a, long_a), (raw_b, long_b) = ragged(*self.bytes_a, a), ragged(*self.bytes_b, b)
        whole = _same(raw, length, raw_a, piece_a, long_a) & _same(raw, length, raw_b, piece_b, long_b)
        mine_a, mine_b = whole[piece_a], whole[piece_b]
        a, piece_a, long_a = a[mine_a], piece_a[mine_a], long_a[mine_a]
        b, piece_b, long_b = b[mine_b], piece_b[mine_b], long_b[mine_b]
        # pieces are laid one after another: their ends are ends of tokens of both
        end_a, end_b = np.cumsum(long_a), np.cumsum(long_b)
        edges = end_a[np.isin(end_a, end_b, assume_unique=True)]
        group_a, group_b = np.searchsorted(edges, end_a), np.searchsorted(edges, end_b)
        groups = len(edges)
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        first_a = np.cumsum(in_a) - in_a
        piece = piece_a[first_a]
        links = in_a * in_b
        sums = lambda of, weight: np.bincount(of, weight, n).astype(np.int64)
        figures = np.stack(
            [
                whole.astype(np.int64), sums(piece_a, None), sums(piece_b, None), sums(piece, None),
                np.add.reduceat(np.append(links, 0), np.searchsorted(piece, np.arange(n))) * (sums(piece, None) > 0),
            ], 1,
        )
        owner, keys, times = self._pairs(a, b, piece, in_a, in_b)
        # a group's tokens of a, then those of b, each with its mark before it
        start_a = np.ones(len(a), bool)
        start_a[1:] = group_a[1:] != group_a[:-1]
        start_b = np.ones(len(b), bool)
        start_b[1:] = group_b[1:] != group_b[:-1]
        new = np.ones(len(a), bool)
        new[1:] = piece_a[1:] != piece_a[:-1]
        mark_a = np.where(new, 0, np.where(start_a, 1, 2))
        mark_b = np.where(start_b, 3, 2)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        names = np.concatenate([mark_a * self.most + a, mark_b * self.most + b])[order]
        text, sizes = ragged(*self.names, names)
        of_text = np.bincount(np.concatenate([piece_a, piece_b])[order], sizes, n).astype(np.int64)
        return [
            (np.full(n, 5), figures.ravel()),
            (np.bincount(owner, minlength=n), keys),
            (np.bincount(owner, minlength=n), times),
            (of_text, text),
        ]

    @staticmethod
    def _pairs(
        a: np.ndarray, b: np.ndarray, piece: np.ndarray, in_a: np.ndarray, in_b: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(piece, key, how often) of the distinct pairs of each piece. Groups of very many pairs are counted by
        distinct ids."""
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        links = in_a * in_b
        few = links <= LINKS
        group = np.repeat(np.flatnonzero(few), links[few])
        at = np.arange(len(group)) - np.repeat(np.cumsum(links[few]) - links[few], links[few])
        x, y = a[first_a[group] + at // in_b[group]], b[first_b[group] + at % in_b[group]]
        parts = [(piece[group], x, y, np.ones(len(group), np.int64))]
        for g in np.flatnonzero(~few):
            ids_a, n_a = np.unique(a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            ids_b, n_b = np.unique(b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            parts.append((np.full(len(ids_a) * len(ids_b), piece[g]), np.repeat(ids_a, len(ids_b)), np.tile(ids_b, len(ids_a)), np.outer(n_a, n_b).ravel()))
        owner, x, y, times = (np.concatenate([p[k] for p in parts]) for k in range(4))
        keys = x.astype(np.uint64) << np.uint64(32) | y.astype(np.uint64)
        order = np.lexsort((keys, owner))
        owner, keys, times = owner[order], keys[order], times[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        one = np.flatnonzero(fresh)
        return owner[one], keys[one], np.add.reduceat(times, one) if len(one) else times


def _table(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, where each begins; one more at the end)."""
    return np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])


def _spans_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = ends - starts
    upto = np.cumsum(sizes)
    return data[np.arange(upto[-1] if len(upto) else 0) + np.repeat(starts - upto + sizes, sizes)], sizes


def _same(raw: np.ndarray, length: np.ndarray, spelled: np.ndarray, piece: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes that a piece's tokens spell are its own."""
    n = len(length)
    own = np.bincount(piece, size, n).astype(np.int64)
    same = own == length
    keep = np.repeat(same, length)
    differ = raw[keep] != spelled[np.repeat(same, own)]
    bad = np.bincount(np.repeat(np.arange(n), length)[keep][differ], minlength=n) > 0
    return same & ~bad


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class Block:
    """The texts of a column, aligned: for distinct pieces their figures and pairs, for texts which pieces they have."""

    def __init__(self, column: pa.Array, tool: Aligner):
        spaced = pc.binary_join_element_wise(pa.scalar(" "), pc.fill_null(column, ""), "")
        data, offsets = utf8(spaced)
        start = np.zeros(len(data), bool)
        start[1:] = BREAK[data[1:]] & BEFORE[data[:-1]] | (data[:-1] == 0x0A) & AFTER[data[1:]]
        start[2:] |= BREAK[data[2:]] & (data[1:-1] >= 0x80) & (data[:-2] >= 0xC3) & (data[:-2] < 0xE0)
        start[offsets[:-1]] = True
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(data))
        hashes, one, self.codes = distinct(data, starts, ends)
        self.store = tool.store
        self.rows = self.store.rows(hashes, lambda new: tool.make(data, starts[one[new]], ends[one[new]]))
        self.first = np.searchsorted(starts, offsets)
        figures = self.store.get(0, self.rows)[0].reshape(-1, 5)
        self.whole, self.figures = figures[:, 0] > 0, figures[:, 1:]
        self.keys, sizes = self.store.get(1, self.rows)
        self.times = self.store.get(2, self.rows)[0]
        self.edges = np.concatenate([[0], np.cumsum(sizes)])
        bad = np.concatenate([[0], np.cumsum(~self.whole[self.codes])])
        # an empty text is the added space alone
        self.ok = (bad[self.first[1:]] == bad[self.first[:-1]]) & (np.diff(offsets) > 1)

    def sums(self, of_piece: np.ndarray) -> np.ndarray:
        """For each text the sum of a figure over its pieces; 0 for texts without tokens."""
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(of_piece[self.codes])])[self.first]
        return np.where(self.ok, np.diff(total), 0)

    def pair_sums(self, of_pair: np.ndarray) -> np.ndarray:
        """The same for a figure of pairs."""
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(of_pair)])[self.edges]
        return self.sums(np.diff(total))

    def groups(self) -> pa.Array:
        """Each text's groups."""
        raw, sizes = self.store.get(3, self.rows)
        upto = np.cumsum(sizes)
        whole = raw.tobytes().decode("ascii")
        names = [whole[a:b] for a, b in zip((upto - sizes).tolist(), upto.tolist(), strict=True)]
        name, codes = names.__getitem__, self.codes.tolist()
        return pa.array(
            [
                ";".join(map(name, codes[a:b])) if ok else ""
                for a, b, ok in zip(self.first[:-1].tolist(), self.first[1:].tolist(), self.ok.tolist(), strict=True)
            ],
            pa.string(),
        )

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct keys, how many texts hold each)."""
        owner = np.repeat(np.arange(len(self.ok)), np.diff(self.first))
        mine = self.ok[owner]
        n = np.int64(max(1, len(self.whole)))
        held = np.unique(owner[mine] * n + self.codes[mine])
        keys, number = np.unique(self.keys, return_inverse=True)
        of_text, sizes = ragged(number, self.edges, held % n)
        per = np.unique(np.repeat(held // n, sizes) * np.int64(max(1, len(keys))) + of_text)
        counts = np.bincount(per % max(1, len(keys)), minlength=len(keys))
        return keys[counts > 0], counts[counts > 0]


# ------------------------------------------------------------------------------------------------- hashing


def _seeded(keys: np.ndarray, k: int) -> np.ndarray:
    return mixed(keys ^ mixed(np.array([k + 1], np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))


def segments_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return (_seeded(keys, 99) % np.uint64(segments)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, the levels' bits in words of 64, the keys in the order of their numbers) of a segment."""
    sizes, words, ordered, left = [], [], [], keys
    while len(left):
        if len(sizes) > 200:
            raise ValueError("keys must be distinct")
        size = -(-ROOM * len(left) // 64) * 64
        at = (_seeded(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        mine = alone[at]
        ordered.append(left[mine][np.argsort(at[mine])])
        sizes.append(size)
        left = left[~mine]
    none = np.zeros(0, np.uint64)
    return sizes, np.concatenate([none, *words]), np.concatenate([none, *ordered])


class PerfectHash:
    """Numbers of the keys of some segments; made of their build() results."""

    def __init__(self, segments: int, built: dict[int, tuple[list[int], np.ndarray, np.ndarray]]):
        self.segments = segments
        levels = max((len(x[0]) for x in built.values()), default=0)
        self.size = np.zeros((segments, levels), np.int64)
        self.start = np.zeros((segments, levels), np.int64)
        at = 0
        for k, (sizes, _, _) in sorted(built.items()):
            self.size[k, : len(sizes)] = sizes
            self.start[k, : len(sizes)] = at + np.cumsum([0, *sizes[:-1]]) if sizes else 0
            at += sum(sizes)
        none = [np.zeros(0, np.uint64)]
        self.words = np.concatenate(none + [x[1] for _, x in sorted(built.items())])
        self.keys = np.concatenate(none + [x[2] for _, x in sorted(built.items())])
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys of other segments."""
        out = np.full(len(keys), -1)
        segment, left = segments_of(keys, self.segments), np.arange(len(keys))
        for level in range(self.size.shape[1]):
            size = self.size[segment[left], level]
            left, size = left[size > 0], size[size > 0]
            bit = self.start[segment[left], level] + (
                _seeded(keys[left], level) % size.astype(np.uint64)
            ).astype(np.int64)
            word, low = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            found = (word >> low) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << low) - np.uint64(1)))
            number = (self.ranks[bit >> 6] + below)[found]
            same = self.keys[number] == keys[left[found]]
            out[left[found][same]] = number[same]
            left = left[~found]
        return out


# ------------------------------------------------------------------------------------------------- counting


def _seen(texts: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(key, docs): pairs and how many documents hold them, summed up within tasks."""

    def run(batches):
        held, size = [], 0

        def out():
            keys, which = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            docs = np.zeros(len(keys), np.int64)
            np.add.at(docs, which, np.concatenate([x[1] for x in held]))
            return keys, docs

        def flush():
            for at in range(0, len(held[0][0]), 1 << 16):
                part = [x[at : at + (1 << 16)].view(np.int64) for x in held[0]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in part], ["key", "docs"])

        for part in blocks(batches, "text", limit=BLOCK):
            held.append(Block(part.column("text"), aligner(*paths)).documents())
            size += len(held[-1][0])
            if size > HELD:
                held = [out()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from flush()
                    held, size = [], 0
        if held:
            held = [out()]
            yield from flush()

    return texts.mapInArrow(run, "key long, docs long")


def _built(keys: DataFrame, segments: int) -> DataFrame:
    """(segment, sizes, words, keys): build() of each segment of distinct keys."""

    def deal(batches):
        for batch in batches:
            key = batch.column("key")
            own = segments_of(key.to_numpy().view(np.uint64), segments)
            yield pa.RecordBatch.from_arrays([pa.array(own), key], ["segment", "key"])

    def make(rows: pa.Table) -> pa.Table:
        sizes, words, ordered = build(rows.column("key").to_numpy().view(np.uint64))
        return pa.Table.from_arrays(
            [
                rows.column("segment").slice(0, 1),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([words.tobytes()]),
                pa.array([ordered.tobytes()]),
            ],
            ["segment", "sizes", "words", "keys"],
        )

    dealt = keys.mapInArrow(deal, "segment long, key long")
    return dealt.groupBy("segment").applyInArrow(make, "segment long, sizes array<long>, words binary, keys binary")


def _dense(seen: DataFrame, table_) -> DataFrame:
    """(chunk, counts): the counts of all numbers, in vectors of CHUNK; tasks' vectors are added up as a tree."""
    plan = "chunk long, part long, counts binary"

    def vector(batches):
        counts = np.zeros(len(table_.value.keys), np.int64)
        for batch in batches:
            number = table_.value.numbers(batch.column("key").to_numpy().view(np.uint64))
            mine = number >= 0
            np.add.at(counts, number[mine], batch.column("docs").to_numpy()[mine])
        part = TaskContext.get().partitionId()
        for chunk in range(-(-len(counts) // CHUNK)):
            own = counts[chunk * CHUNK : (chunk + 1) * CHUNK]
            if own.any():
                yield pa.RecordBatch.from_pylist(
                    [{"chunk": chunk, "part": part, "counts": own.tobytes()}],
                    pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("counts", pa.binary())]),
                )

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in rows.column("counts"))
        return pa.Table.from_arrays(
            [rows.column("chunk").slice(0, 1), rows.column("part").slice(0, 1), pa.array([total.tobytes()])],
            ["chunk", "part", "counts"],
        )

    sums = seen.mapInArrow(vector, plan)
    for _ in range(3):  # 32 of 32 of 32 tasks
        sums = sums.withColumn("part", F.expr("part div 32")).groupBy("chunk", "part").applyInArrow(add, plan)
    return sums.groupBy("chunk").applyInArrow(add, plan).drop("part")


def aligned(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", group: int = GROUP
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every document.

    path_a: a byte-level file of the tokenizers library that splits by PATTERN and whose ids follow the order of merges,
    applied to a space and the text; path_b: a sentencepiece model
    with byte fallback that puts a space before texts; both at the same places on every machine. Strings of special
    tokens are plain text. Groups are cut where tokens of both end, and written as `a1,a2|b1;a3|b2,b3`. A link is a
    token of each in one group; the count of a pair of ids is the number of documents (rows) that link them; n_best are
    links whose count is the highest of any pair of their A id, count_sum adds up the counts of all links.

    Null and empty texts, and those whose tokens do not spell the space and the text, have no tokens: zeros and no
    groups (''). Rows that repeat an id are documents of their own, and so are rows of a null id. Ids are whole numbers
    or cast to them. Other columns are ignored, whatever their names, and an empty table gives an empty result. group:
    pairs that are broadcast at a time, no less than a segment of them."""
    spark, paths = docs.sparkSession, (path_a, path_b)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    seen = save(_seen(plain.select("text"), paths))
    keys = save(seen.select("key").distinct())
    size = keys.count()
    segments = max(1, math.ceil(size / min(SEGMENT, group)))
    at_once = max(1, group // SEGMENT)
    built = save(_built(keys, segments))

    def hashes(low: int) -> PerfectHash:
        rows = built.where(F.col("segment").between(low, low + at_once - 1)).collect()
        return PerfectHash(
            segments,
            {r.segment: (r.sizes, np.frombuffer(r.words, np.uint64), np.frombuffer(r["keys"], np.uint64)) for r in rows},
        )

    vectors, best = {}, np.zeros(1, np.int64)
    for low in range(0, segments, at_once):
        made = hashes(low)
        sent = spark.sparkContext.broadcast(made)
        vectors[low] = save(_dense(seen, sent))
        counts = _whole(vectors[low], len(made.keys))
        of_a = (made.keys >> np.uint64(32)).astype(np.int64)
        best = np.pad(best, (0, max(0, int(of_a.max(initial=0)) + 1 - len(best))))
        np.maximum.at(best, of_a, counts)
        sent.unpersist()

    plan = (
        "doc_id long, text string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups string"
    )
    rounds = list(vectors)
    out = plain
    for low in rounds:
        made = hashes(low)
        sent = spark.sparkContext.broadcast((made, _whole(vectors[low], len(made.keys)), best))
        more = save(out.mapInArrow(_looked_up(sent, paths, low == rounds[0], low == rounds[-1]), plan))
        if low != rounds[0]:
            forget(out)
        out = more
    forget(seen, keys, built, *vectors.values())
    return out.drop("text")


def _whole(vector: DataFrame, size: int) -> np.ndarray:
    """The counts of a group, at most GROUP."""
    out = np.zeros(size, np.int64)
    for r in vector.collect():
        part = np.frombuffer(r.counts, np.int64)
        out[r.chunk * CHUNK : r.chunk * CHUNK + len(part)] = part
    return out


def _looked_up(sent, paths: tuple[str, str], first: bool, last: bool):
    """Adds what the broadcast pairs give to documents; figures are made in the first round, texts go in the last."""

    def run(batches):
        made, counts, best = sent.value
        for part in blocks(batches, "text", limit=BLOCK):
            block = Block(part.column("text"), aligner(*paths))
            number = made.numbers(block.keys)
            count = np.where(number >= 0, counts[number] if len(counts) else 0, 0)
            top = (number >= 0) & (count == best[np.minimum(block.keys >> np.uint64(32), len(best) - 1).astype(np.int64)])
            n_best, total = block.pair_sums(block.times * top), block.pair_sums(block.times * count)
            if first:
                figures = [pa.array(block.sums(block.figures[:, k])) for k in range(4)]
                groups = block.groups()
            else:
                figures = [part.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
                groups = part.column("groups")
                n_best = n_best + part.column("n_best").to_numpy()
                total = total + part.column("count_sum").to_numpy()
            text = pa.nulls(part.num_rows, pa.string()) if last else part.column("text")
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), text, *figures, pa.array(n_best), pa.array(total), groups],
                ["doc_id", "text", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
            )

    return run


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    docs = table(spark, sf_dir, "documents")
    out = aligned(docs, public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model"))
    return out.withColumn(
        "groups_sha256", F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    ).drop("groups")
