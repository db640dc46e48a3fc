"""Packing by lexical retrieval: documents are tokenized, and a sharded BM25 index returns the unused neighbours of each
seed document, which greedily fill its window.

Documents are dealt by the least hash of their tokens, so that those with like vocabularies come into the same shard; equal
least hashes are parted by another hash, so copies of one text are no single task's. A shard of at most SHARD documents
(or TOKENS tokens) is indexed inside its task. A seed takes its neighbours from the best score down while they fit whole;
what no whole document fills is filled by a part of the best one left, whose rest is the next seed. So each window is
full, and one document a window is cut. A window that a shard leaves open is filled from the next. What a task has in
the end goes into sequences of powers of two, which need no padding either."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.common import LOWER, blocks, mixed, save, table, utf8, word_bounds
from landloom.llm.pieces import Store, distinct, places, read

WINDOW, SHARD, TOKENS = 4096, 1024, 1 << 21
#: Pieces of which a Python worker remembers the tokens.
REMEMBERED = 1 << 21
K1, B = 1.2, 0.75


#: Kinds of bytes: white space, letters, digits, marks; anything else (bytes beyond ASCII, control characters, the
#: apostrophe, which begins contractions) stays with its neighbours.
KIND = np.full(256, 4)
KIND[[0x20, *range(0x09, 0x0E)]] = 0
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
KIND[0x30:0x3A] = 2
KIND[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'"]] = 3


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of pieces that are tokenized each on its own, and at which piece each document begins (one more
    at the end): words, cut again between letters, digits and marks, and between digits."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = KIND[data]
    fresh = np.ones(len(data) + 1, bool)
    one, two = kind[:-1], kind[1:]
    fresh[1:-1] = (one == 0) | (two == 0) | ((one != two) & (one != 4) & (two != 4)) | ((one == 2) & (two == 2))
    fresh[offsets] = True
    edges = np.flatnonzero(fresh)
    word = kind[edges[:-1]] > 0
    starts = edges[:-1][word]
    return starts, edges[1:][word], np.searchsorted(starts, offsets)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)
    special = [t.content.encode() for t in tool.get_added_tokens_decoder().values()]
    return tool, special, Store((np.uint32,), REMEMBERED)


def made_by(tool, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(how many ids each word has, all of them); words are encoded together, with blanks between."""
    sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for at in range(0, len(words), 4096):
        part = words[at : at + 4096]
        made = tool.encode(" ".join(part), add_special_tokens=False)
        begin = np.cumsum([0, *[len(w) + 1 for w in part]])
        place = np.array([a for a, _ in made.offsets], np.int64)
        sizes.append(np.bincount(np.searchsorted(begin, place, "right") - 1, minlength=len(part)))
        ids.append(np.array(made.ids, np.uint32))
    return np.concatenate(sizes), np.concatenate(ids)


def token_ids(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of texts one after another, at which each text begins; one more at the end)."""
    tool, special, store = _tokenizer(path)
    if any(x in data.tobytes() for x in special):
        starts, ends, first = word_bounds(data, offsets)
    else:
        data = LOWER[data]  # as the tokenizer does itself; its special tokens have no capitals
        starts, ends, first = cut(data, offsets)
    hashes, one, codes = distinct(data, starts, ends)
    rows = store.rows(hashes, lambda new: [made_by(tool, read(data, starts[one[new]], ends[one[new]]))])
    ids, sizes = store.get(0, rows[codes])
    return ids, np.concatenate([[0], np.cumsum(sizes)])[first]


def tokenize(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, ids, n, near) of docs (doc_id, text): little-endian unsigned 32-bit ids with end_id after them, how
    many, and the least hash of the distinct ones.

    For a tokenizer that lower-cases, drops white space and cuts there and between letters, digits and marks, so the
    tokens of a text are those of such pieces; pieces that recur are tokenized once in a worker, told apart by 64-bit
    hashes."""

    def run(batches):
        for part in blocks(batches, "text"):
            data, offsets = utf8(part.column("text"))
            flat, at = token_ids(path, data, offsets)
            flat = np.insert(flat, at[1:], end_id).astype("<u4")
            at = at + np.arange(len(at))
            near = np.minimum.reduceat(mixed(flat.astype(np.uint64) + np.uint64(1)), at[:-1])
            raw = pa.Array.from_buffers(
                pa.large_binary(), len(at) - 1, [None, pa.py_buffer(4 * at.astype(np.int64)), pa.py_buffer(flat)]
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), raw.cast(pa.binary()), pa.array(np.diff(at)), pa.array(near.view(np.int64))],
                ["doc_id", "ids", "n", "near"],
            )

    return docs.mapInArrow(run, "doc_id long, ids binary, n long, near long")


class Index:
    """BM25 over the documents of a shard; terms are token ids."""

    def __init__(self, docs: list[np.ndarray]):
        sizes = np.array([len(d) for d in docs])
        ids = np.concatenate(docs)
        # a document and an id as one number, of 32 bits where they fit
        bits = int(ids.max()).bit_length()
        kind = np.uint32 if bits + len(docs).bit_length() <= 32 else np.uint64
        pairs = np.repeat(np.arange(len(docs), dtype=kind), sizes) << kind(bits) | ids.astype(kind)
        pairs.sort()
        one = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        tf, pairs = np.diff(np.append(one, len(pairs))), pairs[one]
        self.doc = (pairs >> kind(bits)).astype(np.int64)
        ids = (pairs & kind((1 << bits) - 1)).astype(np.int64)
        df = np.bincount(ids)
        number = np.cumsum(df > 0) - 1
        self.term, df = number[ids], df[df > 0]
        self.of = np.searchsorted(self.doc, np.arange(len(docs) + 1))
        idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5))
        long = K1 * (1 - B + B * sizes / sizes.mean())
        gain = idf[self.term] * tf * (K1 + 1) / (tf + long[self.doc])
        by = np.argsort(self.term.astype(np.uint16) if len(df) <= 1 << 16 else self.term, kind="stable")
        self.edges = np.concatenate([[0], np.cumsum(df)])
        self.held, self.gain = self.doc[by], gain[by]

    def scores(self, doc: int) -> np.ndarray:
        """How well each document answers a query of all distinct tokens of doc."""
        terms = self.term[self.of[doc] : self.of[doc + 1]]
        at, _ = places(self.edges, terms)
        return np.bincount(self.held[at], self.gain[at], len(self.of) - 1)


class Packer:
    """Fills the windows of one task: pieces (document, start, length) of numbered sequences."""

    def __init__(self, window: int, first: int):
        self.window, self.sequence, self.used = window, first, 0
        self.pieces: list[tuple] = []

    def put(self, doc: tuple, start: int) -> int:
        """Put as much of a document as the window has room for; gives where the rest begins."""
        length = min(self.window - self.used, len(doc[1]) - start)
        self.pieces.append((doc, start, length, self.sequence, self.used))
        self.used += length
        if self.used == self.window:
            self.sequence, self.used = self.sequence + 1, 0
        return start + length

    def shard(self, docs: list[tuple]) -> None:
        """Pack all documents (doc_id, ids) of a shard."""
        index = Index([d[1] for d in docs])
        sizes = np.array([len(d[1]) for d in docs])
        free = np.ones(len(docs), bool)
        seed, start = -1, 0
        while seed >= 0 or free.any():
            if seed < 0:
                seed, start = int(np.argmax(free)), 0
                free[seed] = False
            while start < sizes[seed]:
                start = self.put(docs[seed], start)
            score, seed = index.scores(seed), -1
            left = np.flatnonzero(free)
            left = left[np.argsort(-score[left], kind="stable")]
            while self.used and len(left):
                fits = np.flatnonzero(sizes[left] <= self.window - self.used)
                k = int(fits[0]) if len(fits) else 0
                free[left[k]] = False
                rest = self.put(docs[left[k]], 0)
                if rest < sizes[left[k]]:
                    seed, start = int(left[k]), rest
                left = np.delete(left, k)

    def close(self) -> None:
        """Split the open window, if any, into sequences of powers of two."""
        open_ = [p for p in self.pieces if p[3] == self.sequence]
        del self.pieces[len(self.pieces) - len(open_) :]
        left, room = self.used, 0
        for doc, start, length, _, _ in open_:
            while length:
                if not room:
                    size = room = 1 << (left.bit_length() - 1)
                    left -= size
                now = min(room, length)
                self.pieces.append((doc, start, now, self.sequence, size - room))
                start, length, room = start + now, length - now, room - now
                self.sequence += not room


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all documents, each in a sequence of
    window tokens or a power of two; pieces of a sequence follow each other without gaps.

    tokenizer: path of a file of the tokenizers library, at the same place on every machine, that lower-cases and whose
    tokens end at white space and between letters, digits and marks. A document's tokens are those of its text and end_id; a null, empty or blank text has end_id alone. ids are
    little-endian unsigned 32-bit numbers. Rows that repeat an id, and rows of a null id, are packed each on its own.
    Ids are whole numbers or cast to them. Other columns are ignored, whatever their names, and an empty table gives an
    empty result. Runs agree where Spark deals rows alike; save the result before reading it more than once."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    made = save(tokenize(plain, tokenizer, end_id))
    tie = F.xxhash64("doc_id", "ids")
    dealt = made.withColumn("tie", tie).repartitionByRange("near", "tie").sortWithinPartitions("near", "tie", "doc_id")

    def run(batches):
        packer = Packer(window, TaskContext.get().partitionId() << 40)

        def ready(limit: int):
            """The pieces that are complete, in batches."""
            done = len(packer.pieces)
            while done and packer.pieces[done - 1][3] == packer.sequence:
                done -= 1
            if done <= limit:
                return
            rows, packer.pieces = packer.pieces[:done], packer.pieces[done:]
            for at in range(0, len(rows), 256):
                part = rows[at : at + 256]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[0][0] for p in part], pa.int64()),
                        pa.array([p[1] for p in part], pa.int64()),
                        pa.array([p[2] for p in part], pa.int64()),
                        pa.array([p[0][1][p[1] : p[1] + p[2]].tobytes() for p in part], pa.binary()),
                        pa.array([len(p[0][1]) for p in part], pa.int64()),
                        pa.array([p[3] for p in part], pa.int64()),
                        pa.array([p[4] for p in part], pa.int64()),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

        held, tokens = [], 0
        for part in blocks(batches, "ids", limit=1 << 22):
            for i, ids in zip(part.column("doc_id").to_pylist(), part.column("ids"), strict=True):
                held.append((i, np.frombuffer(ids.as_py(), "<u4")))
                tokens += len(held[-1][1])
                if len(held) >= SHARD or tokens >= TOKENS:
                    packer.shard(held)
                    held, tokens = [], 0
                    yield from ready(0)
        if held:
            packer.shard(held)
        packer.close()
        packer.sequence = -1
        yield from ready(0)

    plan = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return dealt.select("doc_id", "ids").mapInArrow(run, plan)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
