"""Secret scans: fixed patterns, and probabilistic automata inferred from the credentials that those find.

Labelled credentials of each kind are turned into strings of character classes. Their prefix tree is folded into a
probabilistic automaton: states in breadth-first order are merged with an earlier state when the frequencies of ending
and of each next symbol, and those of the states they lead to, differ by no more than Hoeffding's bound allows. Every
other token that could be a credential is then scored by its log-likelihood under the best automaton against a
background of ordinary candidates (a chain of pairs of symbols), per symbol; a token as typical as all but a few
labelled credentials is added.

Two maps over whole texts: one finds labelled credentials and a sample of the background, the other finds spans and
scores all candidates. The automata come from at most sample credentials a kind (a documented
bound of the classifier, chosen by hash) and are a few states each."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.common import BYTE_VALUES, annotate, forget, prefixes, save, signed, spans, table, utf8, word_bounds

# fixed values: the kinds and their patterns
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")  # runs of fewer have no later start that is long enough
HEX = re.compile("[0-9a-f]{24,}")
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Of labelled credentials: the characters (runs of them are candidates) and the least length.
CREDENTIAL = re.compile("[A-Za-z0-9+/_.=-]")
LEAST = 6
#: Pieces of a run between its full stops and equals signs.
PIECE = re.compile("[A-Za-z0-9+/_-]{6,}")


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, credential) of the fixed patterns, by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), "assign", m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), "hex", m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[1])))


SYMBOLS = {
    **{c: "0" for c in "0123456789"},
    **{c: "f" if c <= "f" else "z" for c in "abcdefghijklmnopqrstuvwxyz"},
    **{c: "Z" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"},
}
SYMBOL_OF_BYTE = np.array([ord(SYMBOLS.get(chr(b), chr(b))) for b in range(256)], np.uint8)
GAP = np.array([not CREDENTIAL.match(chr(b)) for b in range(256)])


def classes(token: str) -> str:
    """A token as symbols: digit, a-f, other lower-case, upper-case; other characters stand for themselves."""
    return token.translate(str.maketrans(SYMBOLS))


def parts_of(run: str) -> list[tuple[int, int]]:
    """What of a run could be a credential: all of it, then what is left without full stops and equals signs around,
    then its pieces between those. Symbols do as well as characters."""
    own = [(0, len(run))]
    if "." in run or "=" in run:
        core = len(run) - len(run.lstrip(".=")), len(run.rstrip(".="))
        own += [core] * (core[1] - core[0] >= LEAST) + [m.span() for m in PIECE.finditer(run)]
    return list(dict.fromkeys(own))


@dataclass
class Runs:
    """All runs of a column's bytes that are long enough to be candidates, in order."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray  # which text each is in
    at: np.ndarray  # code points of its text before it

    @classmethod
    def of(cls, column: pa.Array) -> Runs:
        data, offsets = utf8(column)
        starts, ends, _ = word_bounds(data, offsets, GAP)
        long = ends - starts >= LEAST
        starts, ends = starts[long], ends[long]
        text = np.searchsorted(offsets, starts, "right") - 1
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return cls(data, starts, ends, text, points[starts] - points[offsets[text]])

    def distinct(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first place, number of each run's) of the distinct runs of data, which is bytes or symbols."""
        return np.unique(
            spans(prefixes(BYTE_VALUES[data]), self.starts, self.ends), return_index=True, return_inverse=True
        )

    def read(self, data: np.ndarray, i: int) -> str:
        return data[self.starts[i] : self.ends[i]].tobytes().decode("ascii")


class Taken:
    """Spans (start, kind, end, token) in order of their starts, asked whether others overlap with any."""

    def __init__(self, spans_: list[tuple[int, str, int, str]]):
        self.starts = [a for a, _, _, _ in spans_]
        self.furthest = list(accumulate((b for _, _, b, _ in spans_), max))

    def free(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return not before or self.furthest[before - 1] <= start


class Node:
    """A state of the prefix tree. tails: (word, how much of it leads here) of words that are not spelled out below."""

    __slots__ = ("path", "ends", "count", "below", "tails")

    def __init__(self, path: tuple[str, int]):
        self.path, self.ends, self.count = path, 0, 0
        self.below: dict[str, Node] = {}
        self.tails: list[tuple[str, int]] = []

    def spelled(self) -> dict[str, Node]:
        """The states below, after the tails have been spelled out by a symbol, or as far as states are spelled out."""
        own, self.tails = self.tails, []
        for word, at in own:
            node = self
            while at < len(word):
                below, c = node.below, word[at]
                at += 1
                node = below.get(c)
                if node is None:
                    node = below[c] = Node((word, at))
                node.count += 1
                if node.tails or not node.below:
                    node.tails.append((word, at))
                    break
            else:
                node.ends += 1
        return self.below


def infer(words: list[str], alpha: float = 0.05, least: int = 10) -> list[tuple[float, dict[str, tuple[float, int]]]]:
    """A probabilistic automaton: per state the probability to end, and for each symbol (probability, next state).

    States seen fewer than least times carry too little evidence to tell apart and are merged with the first state kept;
    what follows them stays a list of words until then, so the tree takes little room beside the words. Probabilities
    are counted over words once the states stand, half a count added to each."""
    root = Node(("", 0))
    root.count, root.tails = len(words), [(w, 0) for w in words]
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(x: int, n: int, y: int, m: int) -> bool:
        return bool(n and m) and abs(x / n - y / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(p: Node, q: Node) -> bool:
        stack = [(p, q)]
        while stack:
            a, b = stack.pop()
            if min(a.count, b.count) < least:
                continue
            of_a, of_b = a.spelled(), b.spelled()
            if differ(a.ends, a.count, b.ends, b.count):
                return False
            for c in of_a.keys() | of_b.keys():
                x, y = of_a.get(c), of_b.get(c)
                if differ(x.count if x else 0, a.count, y.count if y else 0, b.count):
                    return False
                if x and y and x is not y:
                    stack.append((x, y))
        return True

    def fold(p: Node, q: Node) -> None:
        """Add the subtree q to state p."""
        stack = [(p, q)]
        while stack:
            a, b = stack.pop()
            of_a = a.spelled() if b.below else a.below
            a.count += b.count
            a.ends += b.ends
            a.tails += b.tails  # spelled out when they are looked at
            for c, y in b.below.items():
                if c in of_a:
                    stack.append((of_a[c], y))
                else:
                    of_a[c] = y

    kept, place = [root], {id(root): 0}
    while True:
        while any(p.tails for p in kept):  # a kept state may lead back to one before
            for p in kept:
                p.spelled()
        # the states next to kept ones, which may have gained symbols by a fold; those nearest to the start come first
        loose = [
            (t.path[1], t.path[0][: t.path[1]], k, c) for k, p in enumerate(kept) for c, t in p.below.items()
            if id(t) not in place
        ]
        if not loose:
            break
        _, _, k, c = min(loose)
        q = kept[k].below[c]
        same = next((r for r in kept if compatible(r, q)), None)
        if same is None:
            place[id(q)] = len(kept)
            kept.append(q)
        else:
            kept[k].below[c] = same
            fold(same, q)
    moves = [{c: place[id(t)] for c, t in s.below.items()} for s in kept]
    seen = [Counter() for _ in kept]
    for w in words:
        at = 0
        for c in w:
            seen[at][c] += 1
            at = moves[at][c]
        seen[at][""] += 1
    out = []
    for own, step in zip(seen, moves, strict=True):
        total = sum(own.values()) + 0.5 * (len(step) + 1)
        out.append(((own[""] + 0.5) / total, {c: ((own[c] + 0.5) / total, t) for c, t in step.items()}))
    return out


def likelihood(automaton, w: str) -> float:
    """Natural logarithm of the probability of w."""
    at, out = 0, 0.0
    for c in w:
        p, at = automaton[at][1].get(c, (1e-4, at))
        out += math.log(p)
    return out + math.log(automaton[at][0])


def chain(words: list[str], backed: float = 5.0) -> dict[str, float]:
    """Log-probabilities of pairs of neighbouring symbols, the start and the end of a word (a blank) among them: the
    second given the first, smoothed by how common it is."""
    single = Counter("0fzZ+/_=-. ") + Counter(c for w in words for c in w + " ")
    total = sum(single.values())
    pairs = Counter(x + y for w in words for x, y in zip(" " + w, w + " ", strict=True))
    before = Counter(c for w in words for c in " " + w)
    return {
        x + y: math.log((pairs[x + y] + backed * n / total) / (before[x] + backed))
        for x in single
        for y, n in single.items()
    }


def learn(positives: dict[str, list[str]], others: list[str], quantile: float = 0.1):
    """(kind, automaton, threshold) of each kind with enough examples, and the background's log-probabilities."""
    background = chain([classes(w) for w in others])
    out = []
    for kind, tokens in sorted(positives.items()):
        words = sorted(classes(x) for x in tokens)
        if len(words) >= 20:
            automaton = infer(words)
            own = sorted(odds(automaton, background, w) for w in words)
            out.append((kind, automaton, max(0.05, own[int(quantile * len(own))])))
    return out, background


def odds(automaton, background: dict[str, float], w: str) -> float:
    """Log-likelihood ratio against the background, per symbol."""
    return (
        likelihood(automaton, w) - sum(background.get(x + y, -8.0) for x, y in zip(" " + w, w + " ", strict=True))
    ) / (len(w) + 1)


def find(docs: DataFrame, text: str = "text", sample: int = 512) -> DataFrame:
    """(row, spans): every row with its spans as structs (start, kind, end) by start, then kind as listed; the
    automata's spans are of kind format. Positions are code points, ends exclusive.

    Null and empty texts have none. Where no kind has 20 labelled credentials there is nothing to infer, and the fixed
    patterns' spans are all. Other columns ride along in row; an empty table gives an empty result."""
    fields = "array<struct<start:long,kind:string,end:long,token:string>>"
    kind = pa.list_(
        pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("token", pa.string())])
    )

    def labelled(column: pa.Array) -> dict:
        """Spans of the fixed patterns; with a block's first text, the runs of least hash outside them, whose start is
        the hash."""
        base = [base_spans(t or "") for t in column.to_pylist()]
        out = [[{"start": a, "kind": k, "end": b, "token": x} for a, k, b, x in own] for own in base]
        runs, others = Runs.of(column), []
        hashes, first, which = runs.distinct(runs.data)
        clear, taken = np.ones(len(runs.text), bool), [Taken(own) for own in base]
        for i in np.flatnonzero(np.isin(runs.text, [k for k, own in enumerate(base) if own])).tolist():
            clear[i] = taken[runs.text[i]].free(int(runs.at[i]), int(runs.at[i] + runs.ends[i] - runs.starts[i]))
        for k in np.flatnonzero(np.bincount(which, clear, len(hashes)) > 0)[:sample].tolist():
            others.append(
                {
                    "start": int(signed(hashes[k : k + 1])[0]),
                    "kind": "format",
                    "end": 0,
                    "token": runs.read(runs.data, first[k]),
                }
            )
        if out:
            out[0] += others
        return {"base": pa.array(out, kind)}

    found = annotate(docs.select(text), text, f"base {fields}", labelled).select(F.explode("base").alias("z"))
    tokens = save(
        found.select(
            "z.kind",
            "z.token",
            F.when(F.col("z.kind") == "format", F.col("z.start")).otherwise(F.xxhash64("z.token")).alias("h"),
        ).distinct()
    )
    # hashes are in unsigned order
    order = [F.col("h") < 0, F.col("h"), F.col("token")]
    bounded = {
        k: [
            r.token for r in tokens.where(F.col("kind") == k).orderBy(*order).limit(sample).collect()
        ] for k in (*KINDS, "format")
    }
    forget(tokens)
    others = [x[a:b] for x in bounded.pop("format") for a, b in parts_of(x)]
    automata, background = learn(bounded, others)
    known: dict[str, list[tuple[int, int]]] = {}

    def typical(run: str) -> list[tuple[int, int]]:
        """The parts of a run of symbols that are typical; runs of the same symbols are alike."""
        if run in known:
            return known[run]
        good = [
            (a, b) for a, b in parts_of(run) if any(odds(m, background, run[a:b]) >= least for _, m, least in automata)
        ]
        if len(run) <= 64 and len(known) < 1 << 17:
            known[run] = good
        return good

    def make(column: pa.Array) -> dict:
        base = [base_spans(t or "") for t in column.to_pylist()]
        added: list[list[dict]] = [[] for _ in base]
        if automata:
            runs = Runs.of(column)
            symbols = SYMBOL_OF_BYTE[runs.data]
            _, first, which = runs.distinct(symbols)
            good = [typical(runs.read(symbols, i)) for i in first.tolist()]
            taken = [Taken(own) for own in base]
            for i in np.flatnonzero(np.array([bool(g) for g in good], bool)[which]).tolist():
                at, upto, whole = int(runs.at[i]), 0, runs.read(runs.data, i)
                for a, b in good[which[i]]:
                    if b > upto and taken[runs.text[i]].free(at + a, at + b):  # a piece of an added run is none of its own
                        added[runs.text[i]].append(
                            {"start": at + a, "kind": "format", "end": at + b, "token": whole[a:b]}
                        )
                        upto = b
        return {
            "base": pa.array(
                [[{"start": a, "kind": k, "end": b, "token": x} for a, k, b, x in own] for own in base], kind
            ),
            "added": pa.array(added, kind),
        }

    rest = [c for c in docs.columns if c != text]
    scored = annotate(docs, text, f"base {fields}, added {fields}", make).select(
        F.struct(*[F.col("row").getField(c).alias(c) for c in rest]).alias("row"), "base", "added"
    )
    order = {k: i for i, k in enumerate((*KINDS, "format"))}
    rank = lambda z: F.struct(
        z["start"].alias("start"),
        F.element_at(F.create_map(*[F.lit(x) for kv in order.items() for x in kv]), z["kind"]).alias("rank"),
        z["kind"].alias("kind"),
        z["end"].alias("end"),
    )
    return scored.select(
        "row",
        F.sort_array(F.transform("base", rank)).alias("base"),
        F.sort_array(F.transform(F.concat("base", "added"), rank)).alias("spans"),
    )


def joined(column):
    return F.array_join(
        F.transform(column, lambda z: F.concat_ws(":", z["kind"], z["start"].cast("string"), z["end"].cast("string"))),
        ",",
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("base", lambda z: z["kind"] == kind)).cast("long").alias(f"n_{kind}")

    out = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "row.doc_id",
        *[count(k) for k in KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def secrets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op2 counts of the fixed patterns."""
    return op2(spark, sf_dir).select("doc_id", *[f"n_{k}" for k in KINDS])


BASE_SQL = r"""
SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: len(x) >= 6))::BIGINT AS n_assign,
  len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: len(x) >= 20))::BIGINT AS n_access,
  len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: len(x) >= 24))::BIGINT AS n_hex
FROM documents
"""
