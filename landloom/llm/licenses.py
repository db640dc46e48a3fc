"""License scans: ordered signature rules behind a keyword filter.

A rule is a regular expression over lower-cased text with a label, a priority, a confidence and the keywords of which a
text must hold some for the rule to be tried. The rules are written by hand (license_rules): tags, sentences of the
licenses' own texts, grants, addresses and names. Keywords are read off the expression, so that no text with a match
lacks them. Detections are resolved in order of priority: one whose interval lies within a kept detection's interval is
suppressed.

A map over whole texts: nothing is shuffled."""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.llm.common import LOWER, NOT_ALNUM, annotate, table, utf8, word_bounds
from landloom.llm.license_rules import SECTIONS

#: What a blank in a rule stands for.
GAP = r"(?:[^0-9a-z\x80-\xff]+)"

# fixed values: phrases and their labels
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    priority: int
    confidence: float
    #: a text with a match holds all words of one of these sets
    keywords: tuple[frozenset[bytes], ...]


def forms(parsed) -> set[bytes]:
    """What the parsed expression matches, a blank for what separates words and a zero byte for characters that may be
    several; of repetitions, the least number."""
    out = {b""}
    for op, arg in parsed:
        more = {b""}
        if op is parser.LITERAL:
            more = {b" " if NOT_ALNUM[arg] else bytes([arg])}
        elif op is parser.IN:
            more = {b" "} if arg[0][0] is parser.NEGATE else {bytes([x]) for _, x in arg} if all(
                k is parser.LITERAL for k, _ in arg
            ) else {b"\0"}
        elif op is parser.SUBPATTERN:
            more = forms(arg[3])
        elif op is parser.BRANCH:
            more = set().union(*[forms(x) for x in arg[1]])
        elif op is parser.MAX_REPEAT:
            more = forms(arg[2]) | ({b""} if not arg[0] else set())
        out = {x + y for x in out for y in more}
    return out


def words_needed(parsed) -> tuple[frozenset[bytes], ...]:
    """Sets of words, of one of which all stand in whatever the parsed expression matches as whole words."""
    found = {frozenset(w for w in x.split() if b"\0" not in w) for x in forms(parsed)}
    return tuple(sorted((x for x in found if not any(y < x for y in found)), key=sorted))


def make_rule(label: str, pattern: str, priority: int, confidence: float) -> Rule:
    return Rule(label, re.compile(pattern.encode()), priority, confidence, words_needed(parser.parse(pattern.encode())))


def make_rules() -> list[Rule]:
    """In order of priority, then as listed."""
    out = []
    for priority, confidence, lines in SECTIONS:
        for line in lines.strip().split("\n"):
            label, pattern = line.split(None, 1)
            out.append(
                make_rule(
                    label,
                    rf"(?<![0-9a-z\x80-\xff])(?:{pattern.replace(' ', GAP)})(?![0-9a-z\x80-\xff])",
                    priority,
                    confidence,
                )
            )
    return sorted(out, key=lambda r: -r.priority)


WORD = rb"0-9a-z\x80-\xff"
ANY_WORD = re.compile(rb"[" + WORD + rb"]+")
#: The first word is found as a literal; that no word character stands before it is checked afterwards.
PHRASES = [
    (
        re.compile((rb"[^" + WORD + rb"]+").join(p.encode().split()) + rb"(?![" + WORD + rb"])"),
        p.split()[-1].encode(),
        label,
    ) for p, label in BASE.items()
]


def prefilter(rules: list[Rule]) -> dict[bytes, list[tuple[int, frozenset[bytes]]]]:
    """By the longest word of each set of keywords: the rules, by number, and the sets."""
    by: dict[bytes, list[tuple[int, frozenset[bytes]]]] = {}
    for k, rule in enumerate(rules):
        for words in rule.keywords:
            by.setdefault(max(words, key=lambda w: (len(w), w)), []).append((k, words))
    return by


def detect(
    low: bytes, rules: list[Rule], by: dict[bytes, list[tuple[int, frozenset[bytes]]]]
) -> list[tuple[int, int, str, float]]:
    """(start, end, label, confidence) in bytes, of what is left after suppression. by: prefilter(rules)."""
    words = set(ANY_WORD.findall(low))
    kept: list[tuple[int, int, str, float]] = []
    starts: list[int] = []  # of what is kept, ascending
    furthest: list[int] = []  # for each, the largest end up to it
    for k in sorted({k for w in by.keys() & words for k, own in by[w] if own <= words}):
        before = len(kept)
        for m in rules[k].pattern.finditer(low):  # a rule's own matches don't overlap
            at = bisect_right(starts, m.start()) - 1
            if at < 0 or furthest[at] < m.end():
                kept.append((m.start(), m.end(), rules[k].label, rules[k].confidence))
        if len(kept) > before:
            order = sorted((a, b) for a, b, _, _ in kept)
            starts, furthest = [a for a, _ in order], list(accumulate((b for _, b in order), max))
    return kept


FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row.

    n_base: places where a phrase of BASE stands as consecutive words; first_word and last_word: the smallest and
    largest word at which one begins, else null. labels: those of BASE and of the rules. score: the highest confidence,
    0 without any. Null and empty texts have no words and no labels. Other columns ride along in row; an empty table
    gives an empty result."""
    ready: list = []

    def make(column: pa.Array) -> dict:
        if not ready:  # once in a worker
            rules = make_rules()
            ready.extend([rules, prefilter(rules)])
        data, offsets = utf8(column)
        data = LOWER[data]
        starts, _, first = word_bounds(data, offsets, NOT_ALNUM)
        out: dict[str, list] = {x.split()[0]: [] for x in FIELDS.split(", ")}
        for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            low = data[a:b].tobytes()
            places, base, found = [], set(), []
            for pattern, last, label in PHRASES:
                if last in low:
                    for m in pattern.finditer(low):
                        if not m.start() or NOT_ALNUM[low[m.start() - 1]]:
                            places.append(int(np.searchsorted(starts, a + m.start()) - first[k]))
                            base.add(label)
            found = detect(low, *ready)
            out["n_words"].append(int(first[k + 1] - first[k]))
            out["n_base"].append(len(places))
            out["first_word"].append(min(places, default=None))
            out["last_word"].append(max(places, default=None))
            out["base_labels"].append(",".join(sorted(base)))
            out["labels"].append(",".join(sorted(base | {x[2] for x in found})))
            out["score"].append(max([x[3] for x in found] + [0.95] * bool(base), default=0.0))
        kinds = {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
        return {c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()}

    return annotate(docs, text, FIELDS, make)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", *[x.split()[0] for x in FIELDS.split(", ")])


BASE_FIELDS = ["n_words", "n_base", "first_word", "last_word", "base_labels"]


def licenses_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op5 has of the fixed phrases."""
    return op5(spark, sf_dir).select("doc_id", *BASE_FIELDS)


BASE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT unnest(['under the mit license', 'apache license version 2', 'cc by nc']) AS phrase, unnest(['mit', 'apache-2', 'cc-by-nc']) AS label),
places AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos, w FROM w),
f AS (SELECT doc_id, pos, label FROM places JOIN p ON word = split_part(phrase, ' ', 1) AND array_to_string(w[pos + 1:pos + len(string_split(phrase, ' '))], ' ') = phrase),
g AS (SELECT doc_id, count(*) AS n, min(pos) AS a, max(pos) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM f GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, b::BIGINT AS last_word, coalesce(labels, '') AS base_labels FROM w LEFT JOIN g USING (doc_id)
"""
