"""Suffix-array dedup by a common-prefix-aware distributed merge sort, on bytes.

A byte goes when a string of length bytes around it also starts anywhere else. Every such string selects, by winnowing,
an anchor (the place of its least hash of seed bytes) that equal strings share at the same offset, so it is enough to
sort the suffixes that start at anchors whose hash occurs more than once, each to length bytes. A suffix's key is the
suffix, an end mark, and what stands before it, backwards: so equal suffixes are sorted by how much they share to the
left.

1. Tasks sort their keys into runs. Equal keys of a run are one entry with their number. Runs are front-coded (common
   prefix with the entry before, then the rest) in blocks.
2. Blocks are exchanged by ranges of keys, as many as their number asks for; a block that crosses a border is cut there.
3. Each range is merged by a loser tree whose entries remember their common prefix with the last winner: the longer one
   wins unseen, and only on a tie are bytes compared, from where the known prefix ends. The front coding supplies what
   the next entry of a run has in common with the one before, so known prefixes are never compared again. The common
   prefixes of neighbours come out of the tree by themselves.
4. Entries that begin with the same seed bytes come out together. Borders lie between such groups, but for groups that
   are larger than a range. Each entry of a group of at most GROUP is extended both ways: classes of equal suffixes are
   joined in order of falling common prefix, the smaller to the larger, and an entry is compared with its neighbours in
   the order of left contexts, which share most with it: n log n comparisons.
5. In a larger group, or one that borders cut, an entry's neighbours tell how far it is repeated to the left by equal
   suffixes (c), and how many bytes the nearest other suffix shares (r2); at a border, the neighbours are the last and
   first entries of the ranges beside it. So all is known but for strings of which at most r2 bytes lie to the right of
   the anchor; these alone are compared by 128-bit hashes. Which they are depends on the strings alone, so equal ones
   are all there or all absent.

A task holds a range of some 16,000 entries, whatever their keys have in common; the driver holds a key for each range.
A passage that every third document holds is one entry per run, and its beginnings, which differ to the left, are cut
into ranges."""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landloom.llm.common import (
    BYTE_VALUES,
    annotate,
    blocks,
    covered,
    forget,
    inside,
    look_up,
    mixed,
    prefixes,
    runs,
    save,
    signed,
    table,
    utf8,
    windows,
    winnow,
)
from landloom.llm.substrings import only

LENGTH, SEED = 200, 64
RUN_BYTES, BLOCK_ENTRIES, RANGE_BLOCKS = 24 << 20, 256, 64
GROUP = 1 << 16
#: Ends a suffix in its key; no byte of UTF-8.
END = b"\xff"


def common(a: bytes, b: bytes, h: int) -> int:
    """Length of the common prefix of a and b, of which h bytes are known."""
    n = min(len(a), len(b))
    x, y = a[h:n], b[h:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) // 8


def key_of(data: bytes, at: int, length: int, reach: int) -> bytes:
    return data[at : at + length] + END + data[max(0, at - reach) : at][::-1]


def shared(a: bytes | None, b: bytes | None) -> tuple[int, int]:
    """(bytes that the suffixes of two keys have in common, bytes to the left if they are equal, else -1)."""
    if a is None or b is None:
        return 0, -1
    n, size = common(a, b, 0), a.index(END)
    return (size, n - size - 1) if n > size else (min(n, size, b.index(END)), -1)


# ------------------------------------------------------------------------------------------------- runs and blocks


def pack(entries: list[tuple[int, bytes, int]]) -> bytes:
    """A block of (common prefix with the entry before, key, number), compressed; the first key is whole."""
    numbers = np.array([(e[0], len(e[1]), min(e[2], 2)) for e in entries], np.int32)
    raw = struct.pack("<i", len(entries)) + numbers.tobytes() + b"".join(
        e[1] if not k else e[1][e[0] :] for k, e in enumerate(entries)
    )
    return struct.pack("<i", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> list[tuple[int, bytes, int]]:
    blob = pa.decompress(blob[4:], struct.unpack_from("<i", blob)[0], codec="zstd", asbytes=True)
    (n,) = struct.unpack_from("<i", blob)
    at, out, last = 4 + n * 12, [], b""
    for k, (lcp, size, number) in enumerate(np.frombuffer(blob, np.int32, n * 3, 4).reshape(n, 3).tolist()):
        known = lcp if k else 0
        last = last[:known] + blob[at : at + size - known]
        at += size - known
        out.append((lcp, last, number))
    return out


def sorted_run(keys: list[bytes]) -> tuple[list[int], list[tuple[int, bytes, int]]]:
    """(entry of each key, entries in order)."""
    of, entries = [0] * len(keys), []
    last = None
    for i in sorted(range(len(keys)), key=keys.__getitem__):
        if keys[i] == last:
            entries[-1] = (*entries[-1][:2], entries[-1][2] + 1)
        else:
            entries.append((common(last, keys[i], 0) if last is not None else 0, keys[i], 1))
            last = keys[i]
        of[i] = len(entries) - 1
    return of, entries


RUN_SCHEMA = "run long, entry long, id long, same long, at long, head binary, tail binary, block binary"


def make_runs(spots: DataFrame, length: int, seed: int) -> DataFrame:
    """Two kinds of rows of spots(id, same, text, ats): members (run, entry, id, same, at) and blocks (run, entry, head,
    tail, block), where entry is the first one's number, and head and tail are the first and last keys."""
    names = [x.split()[0] for x in RUN_SCHEMA.split(", ")]

    def rows_of(run: int, spot: list[tuple[int, int, int]], keys: list[bytes]) -> Iterator[pa.RecordBatch]:
        of, entries = sorted_run(keys)
        n = len(of)
        empty = pa.nulls(n, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([run] * n),
                pa.array(of, pa.int64()),
                *[pa.array(c, pa.int64()) for c in zip(*spot, strict=True)],
                empty,
                empty,
                empty,
            ],
            names,
        )
        starts = range(0, len(entries), BLOCK_ENTRIES)
        for many in (starts[k : k + 64] for k in range(0, len(starts), 64)):
            none = pa.nulls(len(many), pa.int64())
            cut = [entries[k : k + BLOCK_ENTRIES] for k in many]
            made = [
                pa.array(x, pa.binary()) for x in (
                    [c[0][1] for c in cut], [c[-1][1] for c in cut], [pack(c) for c in cut]
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([run] * len(many)), pa.array(list(many), pa.int64()), none, none, none, *made], names
            )

    def run(batches):
        number, held = TaskContext.get().partitionId() << 20, 0
        spot, keys = [], []
        for part in blocks(batches, "text"):
            for i, s, text, ats in zip(
                *[part.column(c).to_pylist() for c in ("id", "same", "text", "ats")], strict=True
            ):
                data = text.encode()
                spot += [(i, s, a) for a in ats]
                keys += [key_of(data, a, length, length - seed) for a in ats]
                held += len(ats) * (2 * length - seed)
                if held > RUN_BYTES:
                    yield from rows_of(number, spot, keys)
                    number, held = number + 1, 0
                    spot, keys = [], []
        if keys:
            yield from rows_of(number, spot, keys)

    return spots.select("id", "same", "text", "ats").mapInArrow(run, RUN_SCHEMA)


def cut_block(blob: bytes, entry: int, low: int, high: int, cuts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(range, first entry, block): a block that reaches from range low to range high, cut at the borders between."""
    entries = unpack(blob)
    keys, start = [e[1] for e in entries], 0
    for k in range(low, high + 1):
        end = bisect_left(keys, cuts[k]) if k < high else len(keys)
        if end > start:
            yield k, entry + start, pack(entries[start:end])
        start = end


# ------------------------------------------------------------------------------------------------- merging


class LoserTree:
    """Merges sorted runs of (common prefix with the entry before, key, ...) into (common prefix, run, entry), in
    order."""

    def __init__(self, sources: list[Iterator[tuple]]):
        self.sources = sources
        self.now: list[tuple | None] = [next(s, None) for s in sources]
        self.known = [0] * len(sources)
        self.size = 1
        while self.size < max(1, len(sources)):
            self.size *= 2
        self.losers = [-1] * self.size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size if node - self.size < len(self.sources) else -1
        won, lost = self._play(self._build(2 * node), self._build(2 * node + 1))
        self.losers[node] = lost
        return won

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows its common prefix with the winner."""
        if b < 0 or self.now[b] is None:
            return a, b
        if a < 0 or self.now[a] is None:
            return b, a
        ha, hb = self.known[a], self.known[b]
        if ha != hb:
            return (a, b) if ha > hb else (b, a)
        x, y = self.now[a][1], self.now[b][1]
        h = common(x, y, ha)
        if h == len(x) or (h < len(y) and x[h] < y[h]):
            self.known[b] = h
            return a, b
        self.known[a] = h
        return b, a

    def __iter__(self) -> Iterator[tuple[int, int, tuple]]:
        while self.winner >= 0 and (entry := self.now[self.winner]) is not None:
            k = self.winner
            yield self.known[k], k, entry
            self.now[k] = following = next(self.sources[k], None)
            if following is not None:
                self.known[k] = following[0]
            node = (k + self.size) // 2
            while node:
                k, self.losers[node] = self._play(k, self.losers[node])
                node //= 2
            self.winner = k


#: Of an extended group: a row for each way in which an entry repeats, c bytes before its anchor and size from there on.
#: Of others: its suffix, c (-1: no equal suffix) and r2. low, high: which border of the range cuts its class off from
#: others (r2) or itself from its neighbour (2).
FOUND = "part int, run long, entry long, size int, c int, r2 int, low int, high int, first binary, last binary, after binary, before binary"


def merge_part(
    runs_of: dict[int, list[tuple[int, bytes]]],
    low: bytes | None,
    high: bytes | None,
    length: int,
    seed: int,
    most: int,
) -> Iterator[tuple]:
    """Rows (run, entry, size, c, r2, low, high) of the entries of a range (see FOUND), then one of its first and last
    keys and of the suffixes after the first's and before the last's equals (None: there are none). runs_of: blocks of
    each run in order; most: the largest group that is extended."""

    def source(run: int) -> Iterator[tuple]:
        for first, blob in runs_of[run]:
            for k, e in enumerate(unpack(blob)):
                yield (*e, run, first + k)

    def cut(border: bytes | None, key: bytes) -> bool:
        return border is not None and len(border) > seed and border[:seed] == key[:seed]

    first, last, before, after = None, None, None, None
    group: list[tuple[int, bytes, int, int, int]] = []  # common prefix with the entry before, key, number, run, entry
    for known, _, (_, key, n, run, entry) in LoserTree([source(k) for k in runs_of]):
        if first is None:
            first = key
        elif known <= key.index(END):  # another suffix than the last one
            before = last[: last.index(END)]
            after = after or key[: key.index(END)]
        last = key
        if group and known < seed:
            yield from group_rows(group, cut(low, group[0][1]), False, length, most)
            group = []
        group.append((known if group else 0, key, n, run, entry))
    if group:
        # of the first group, the lower border was seen to before unless it is also the last
        yield from group_rows(
            group, cut(low, group[0][1]) and group[0][1] == first, cut(high, group[0][1]), length, most
        )
    yield first, last, after, before


def group_rows(group: list, low: bool, high: bool, length: int, most: int) -> Iterator[tuple]:
    """Rows of merge_part() for one group; low, high: a border of the range cuts it."""
    classes: list[tuple[bytes, int, list[tuple[int, int, int, bytes, int]]]] = []
    for known, key, n, run, entry in group:
        size = key.index(END)
        if not classes or known <= size:
            classes.append((key[:size], min(known, size), []))
        classes[-1][2].append((run, entry, n, key[size + 1 :], known - size - 1))
    if len(group) <= most and not low and not high:
        yield from ((*x, 0, 0, 0) for x in extended(classes, length))
        return
    for k, (s, before, own) in enumerate(classes):
        r2 = max(before, classes[k + 1][1] if k + 1 < len(classes) else 0)
        edge = low and k == 0, high and k == len(classes) - 1
        for j, (run, entry, n, left, known) in enumerate(own):
            c = max(len(left) if n > 1 else -1, known if j else -1, own[j + 1][4] if j + 1 < len(own) else -1)
            yield run, entry, len(s), c, r2, edge[0] * (1 + (j == 0)), edge[1] * (1 + (j == len(own) - 1))


def extended(group: list, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(run, entry, size, c) for each way in which an entry repeats, of a group of classes as in group_rows()."""
    found: dict[tuple[int, int], dict[int, int]] = {}

    def note(a, right: int, left: int) -> None:
        own = found.setdefault(a[:2], {})
        own[right] = max(own.get(right, 0), left)

    entries = [e for c in group for e in c[2]]
    order = sorted(range(len(entries)), key=lambda i: entries[i][3])
    by_rank = [entries[i] for i in order]
    rank = {i: k for k, i in enumerate(order)}

    def compare(x: int, y: int, right: int) -> None:
        a, b = by_rank[x], by_rank[y]
        left = common(a[3], b[3], 0)
        if left + right >= length:
            note(a, right, left)
            note(b, right, left)

    held, at = [], 0  # ranks of each block of classes, in order
    for s, _, own in group:
        ranks = sorted(rank[i] for i in range(at, at + len(own)))
        at += len(own)
        for e in own:
            if e[2] > 1 and len(e[3]) + len(s) >= length:
                note(e, len(s), len(e[3]))
        for x, y in zip(ranks, ranks[1:], strict=False):
            compare(x, y, len(s))
        held.append(ranks)
    block = list(range(len(group)))

    def find(k: int) -> int:
        while block[k] != k:
            block[k] = block[block[k]]
            k = block[k]
        return k

    for k in sorted(range(1, len(group)), key=lambda k: -group[k][1]):
        small, large = sorted((find(k - 1), find(k)), key=lambda j: len(held[j]))
        others, right = held[large], group[k][1]
        for x in held[small]:
            j = bisect_left(others, x)
            if j:
                compare(others[j - 1], x, right)
            if j < len(others):
                compare(x, others[j], right)
        held[large] = sorted(others + held[small])
        held[small], block[small] = [], large
    for (run, entry), own in found.items():
        best = -1
        for right in sorted(own, reverse=True):
            if own[right] > best:  # else a longer one covers as much to the left
                best = own[right]
                yield run, entry, right, best


def merged(table_of_runs: DataFrame, length: int, seed: int) -> DataFrame:
    """(run, entry, size, c, r2) of all entries, as in FOUND, with what lies beyond the borders of their ranges."""
    parts = table_of_runs.where("block IS NOT NULL")
    wanted = max(1, ceil(parts.count() / RANGE_BLOCKS))
    heads = sorted(
        bytes(r.head) for r in parts.select("head").orderBy(F.xxhash64("head"), "run").limit(4 * wanted).collect()
    )
    cuts = [heads[k * len(heads) // wanted] for k in range(1, wanted)] if heads else []
    # between groups, but within those that are larger than a range
    starts = [c[:seed] for c in cuts]
    several = {a for a, b in zip(starts, starts[1:], strict=False) if a == b}
    cuts = sorted({c if c[:seed] in several else c[:seed] for c in cuts})

    def deal(batches):
        for batch in batches:
            rows = []
            for run, entry, head, tail, blob in zip(
                *[batch.column(c).to_pylist() for c in ("run", "entry", "head", "tail", "block")], strict=True
            ):
                low, high = bisect_right(cuts, head), bisect_right(cuts, tail)
                rows += [
                    (k, run, e, b) for k, e, b in (
                        [(low, entry, blob)] if low == high else cut_block(blob, entry, low, high, cuts)
                    )
                ]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c, t) for c, t in zip(
                        columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True
                    )
                ],
                ["part", "run", "entry", "block"],
            )

    most = GROUP
    schema = pa.schema(
        [
            (
                x.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]]
            ) for x in FOUND.split(", ")
        ]
    )

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("run", "ascending"), ("entry", "ascending")])
        k = group.column("part")[0].as_py()
        by: dict[int, list[tuple[int, bytes]]] = {}
        for r, e, b in zip(*[group.column(c).to_pylist() for c in ("run", "entry", "block")], strict=True):
            by.setdefault(r, []).append((e, b))
        *rows, ends = merge_part(by, cuts[k - 1] if k else None, cuts[k] if k < len(cuts) else None, length, seed, most)
        rows = [(k, *x, None, None, None, None) for x in rows if x[3] >= 0 or x[4] >= seed or x[5] or x[6]]
        rows.append((k, None, None, None, None, None, None, None, *ends))
        return pa.table(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
        )

    dealt = parts.select("run", "entry", "head", "tail", "block").mapInArrow(
        deal, "part int, run long, entry long, block binary"
    )
    found = save(dealt.groupBy("part").applyInArrow(run, FOUND))
    rows = found.where("run IS NOT NULL").select("part", "run", "entry", "size", "c", "r2", "low", "high")
    if several:
        rows = rows.where("low = 0 AND high = 0").unionByName(
            beyond_borders(rows.where("low > 0 OR high > 0"), found.where("run IS NULL"))
        )
    return rows.where((F.col("c") >= 0) | (F.col("r2") >= seed)).select("run", "entry", "size", "c", "r2")


def beyond_borders(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """rows with c and r2 as they are with the neighbours beyond a border: for each range, the nearest key on either
    side, and the nearest suffix that differs from the one at the border. ends has one row per range, in order by a
    window over those alone."""
    order = Window.orderBy("part")
    near = ends.select("part", "first", "last", "after", "before").withColumns(
        {"prev": F.lag("last").over(order), "next": F.lead("first").over(order)}
    )
    same = F.arrow_udf(
        lambda a, b: pa.array(
            [shared(x, y)[1] >= 0 for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_()
        ),
        "boolean",
    )
    near = near.withColumns({"joins_prev": same("first", "prev"), "joins_next": same("last", "next")})
    # the suffix before (after) the class at a range's end, null where it comes from the range before (after)
    near = near.withColumns({
        "b": F.when(F.col("before").isNotNull(), F.col("before")).when(~F.col("joins_prev"), F.coalesce("prev", F.lit(b""))),
        "a": F.when(F.col("after").isNotNull(), F.col("after")).when(~F.col("joins_next"), F.coalesce("next", F.lit(b""))),
    })
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    near = near.withColumns(
        {"lower": F.last("b", ignorenulls=True).over(earlier), "upper": F.first("a", ignorenulls=True).over(later)}
    )
    near = near.select(
        "part",
        "first",
        "last",
        "prev",
        "next",
        F.when(F.col("joins_prev"), F.col("lower")).otherwise(F.col("prev")).alias("lower"),
        F.when(F.col("joins_next"), F.col("upper")).otherwise(F.col("next")).alias("upper"),
    )

    def compared(batches):
        for batch in batches:
            out = []
            for part, first, last, prev, following, lower, upper in zip(
                *[batch.column(c).to_pylist() for c in batch.schema.names], strict=True
            ):
                mark = lambda x: x if x is None or END in x else x + END
                out.append(
                    (
                        part,
                        shared(first, prev)[1],
                        shared(last, following)[1],
                        shared(first, mark(lower))[0],
                        shared(last, mark(upper))[0],
                    )
                )
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32()) for c in columns], ["part", "c1", "c2", "r1", "r3"]
            )

    facts = near.mapInArrow(compared, "part int, c1 int, c2 int, r1 int, r3 int")
    at = lambda test, c: F.when(test, F.col(c)).otherwise(-1)
    out = rows.join(facts, "part")
    c = F.greatest("c", at(F.col("low") == 2, "c1"), at(F.col("high") == 2, "c2"))
    r2 = F.greatest("r2", at(F.col("low") > 0, "r1"), at(F.col("high") > 0, "r3"))
    return out.withColumns({"c": c.cast("int"), "r2": r2.cast("int")}).select(
        "part", "run", "entry", "size", "c", "r2", "low", "high"
    )


# ------------------------------------------------------------------------------------------------- the operator


def repeated_bytes(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(id, same, spans): the repeated strings, as structs (start, end) of bytes, of docs(id, same, text), where same is
    a hash of the text. Spans may touch or overlap."""

    def anchors(column: pa.Array) -> dict:
        data, offsets = utf8(column)
        grams = windows(prefixes(BYTE_VALUES[data]), seed)
        at = winnow(
            grams, length - seed + 1, inside(offsets, length, len(data) - length + 1)
        )[1] if len(data) >= length else np.zeros(0, np.int64)
        cuts = np.searchsorted(at, offsets).astype(np.int32)
        own = at - offsets[np.searchsorted(offsets, at, "right") - 1]
        return {
            "h": pa.ListArray.from_arrays(cuts, pa.array(signed(grams[at]))),
            "at": pa.ListArray.from_arrays(cuts, pa.array(own.astype(np.int32))),
        }

    each = save(annotate(docs, "text", "h array<long>, at array<int>", anchors).select("row.id", "row.same", "h", "at"))
    often = save(each.select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    spots = each.select("id", "same", F.explode(F.arrays_zip("h", "at")).alias("z")).select("id", "same", "z.h", "z.at")
    spots = save(look_up(spots, often, ["h"], ["id", "at"]).groupBy("id", "same").agg(F.collect_set("at").alias("ats")))
    ids = save(spots.select("id").distinct())
    table_of_runs = save(make_runs(only(docs, ids, "id").join(spots, ["id", "same"]), length, seed))
    forget(each, often, ids)
    found = save(merged(table_of_runs, length, seed))
    reach = table_of_runs.where("block IS NULL").select(
        "run", "entry", "id", "same", "at"
    ).join(found, ["run", "entry"])
    plain = reach.where(F.col("c") + F.col("size") >= length).select(
        "id",
        "same",
        F.struct(
            (F.col("at") - F.col("c")).cast("int").alias("start"),
            (F.col("at") + F.col("size")).cast("int").alias("end"),
        ).alias("span"),
    )
    open_ = save(
        reach.where(F.col("r2") >= seed).groupBy("id", "same").agg(F.collect_set(F.struct("at", "r2")).alias("z"))
    )

    def strings(batches):
        """The hashes of the strings that other suffixes may hold."""
        for part in blocks(batches, "text"):
            rows: list = []
            for text, z in zip(part.column("text").to_pylist(), part.column("z"), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                at, r2 = (z.values.field(k).to_numpy() for k in range(2))
                order = np.argsort(at)
                at, r2 = at[order], r2[order]
                sums = prefixes(BYTE_VALUES[data])
                grams = windows(sums, seed)
                least, chosen = winnow(grams, length - seed + 1, np.ones(len(data) - length + 1, bool))
                s = np.arange(len(least))
                k = np.searchsorted(chosen, s)
                while True:  # the first anchor of each string that has its least hash
                    off = grams[chosen[k]] != least
                    if not off.any():
                        break
                    k += off
                x = chosen[k]
                j = np.minimum(np.searchsorted(at, x), len(at) - 1)
                ask = np.flatnonzero((at[j] == x) & (length - (x - s) <= r2[j]))
                h1, h2 = windows(sums, length)[ask], windows(
                    prefixes(mixed(BYTE_VALUES[data] + np.uint64(1))), length
                )[ask]
                rows.append((signed(h1).tolist(), signed(h2).tolist(), ask.tolist()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            kinds = pa.int64(), pa.int64(), pa.int32()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("same"),
                    *[pa.array(v, pa.list_(t)) for v, t in zip(columns, kinds, strict=True)],
                ],
                ["id", "same", "h1", "h2", "at"],
            )

    some = save(open_.select("id").distinct())
    if some.isEmpty():
        out = save(plain.groupBy("id", "same").agg(F.collect_set("span").alias("spans")))
        forget(spots, table_of_runs, found, open_, some)
        return out
    held = only(docs, some, "id").join(open_, ["id", "same"]).select("id", "same", "text", "z").mapInArrow(
        strings, "id long, same long, h1 array<long>, h2 array<long>, at array<int>"
    )
    asked = save(
        held.select("id", "same", F.explode(F.arrays_zip("h1", "h2", "at")).alias("z")).select("id", "same", "z.*")
    )
    twice = save(asked.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1"))
    more = look_up(asked, twice, ["h1", "h2"], ["id", "at"]).select(
        "id", "same", F.struct(F.col("at").alias("start"), (F.col("at") + length).alias("end")).alias("span")
    )
    out = save(plain.unionByName(more).groupBy("id", "same").agg(F.collect_set("span").alias("spans")))
    forget(spots, table_of_runs, found, open_, some, asked, twice)
    return out


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED
) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept): every row with the bytes of its UTF-8 text that stay, in one piece.

    A byte goes when a string of length bytes around it also starts anywhere else, in the same document too; matches
    never cross documents, and strings are judged on the input. Null and empty texts have no bytes. Every row is a
    document of its own, whatever its id, so equal rows are copies of each other and go entirely if they are long
    enough. kept is binary, as characters may be cut. An empty table gives an empty result; other columns ride along in
    row."""
    key = [F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 62))).alias("id"), F.xxhash64(text).alias("same")]
    plain = docs.where(F.octet_length(text) >= length).select(*key, F.col(text).alias("text"))
    spans = repeated_bytes(plain, length, seed)
    rows = docs.select(F.struct("*").alias("row"), *key, F.col(text).alias("_text"))
    held = rows.join(spans, ["id", "same"], "left")

    def cut(batches):
        for part in blocks(batches, "_text"):
            out = []
            for x, s in zip(part.column("_text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                data = (x or "").encode()
                if s:
                    gone = covered(len(data), np.array([z["start"] for z in s]), np.array([z["end"] for z in s]))
                    out.append(
                        (len(data), int(gone.sum()), len(runs(gone)[0]), np.frombuffer(data, np.uint8)[~gone].tobytes())
                    )
                else:
                    out.append((len(data), 0, 0, data))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    *[
                        pa.array(v, t) for v, t in zip(
                            columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True
                        )
                    ],
                ],
                ["row", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = StructType(
        [rows.schema["row"], *StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept binary")]
    )
    return held.select("row", "_text", "spans").mapInArrow(cut, schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, unnest(range(0, n - 199)) AS i, unnest(list_transform(range(0, n - 199), lambda i: md5(substr(x, 2 * i + 1, 400)))) AS h FROM d WHERE n >= 200),
t AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
g AS (SELECT doc_id, i, i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 200 AS fresh FROM w JOIN t USING (h)),
k AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM k GROUP BY doc_id, run),
e AS (SELECT s.*, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM s),
c AS (SELECT e.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept FROM e JOIN d USING (doc_id) GROUP BY e.doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM d LEFT JOIN c USING (doc_id)
"""
