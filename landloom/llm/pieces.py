"""Work on the distinct pieces of texts: told apart by 64-bit hashes, made once and remembered in flat arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from landloom.llm.common import BYTE_VALUES, prefixes, spans


def places(edges: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the values of rows stand, one row after another, and how many each has; row i's are those from edges[i] to
    edges[i + 1]."""
    sizes = edges[rows + 1] - edges[rows]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(edges[rows] - ends + sizes, sizes), sizes


def ragged(values: np.ndarray, edges: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of rows one after another, and how many each has; row i's are values[edges[i]:edges[i + 1]]."""
    at, sizes = places(edges, rows)
    return values[at], sizes


class Growing:
    """An array that values are appended to."""

    def __init__(self, kind):
        self.held, self.n = np.zeros(1024, kind), 0

    def append(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            bigger = np.zeros(max(2 * len(self.held), self.n + len(more)), self.held.dtype)
            bigger[: self.n] = self.held[: self.n]
            self.held = bigger
        self.held[self.n : self.n + len(more)] = more
        self.n += len(more)

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.n]


class Store:
    """What has been made of distinct pieces: for each piece a row of values in each column. It is emptied where it
    would hold more than most pieces or room values in a column."""

    def __init__(self, kinds: tuple, most: int, room: int = 1 << 24):
        self.kinds, self.most, self.room = kinds, most, room
        self.clear()

    def clear(self) -> None:
        self.columns = [Growing(k) for k in self.kinds]
        self.edges = [Growing(np.int64) for _ in self.kinds]
        for e in self.edges:
            e.append(np.zeros(1, np.int64))
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.large, self.small = none, none  # hashes, ascending, and their rows; the small index is merged now and then

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        rows = np.full(len(hashes), -1)
        for known, at in (self.large, self.small):
            if len(known):
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                rows = np.where(known[place] == hashes, at[place], rows)
        return rows

    def rows(self, hashes: np.ndarray, make: Callable[[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]) -> np.ndarray:
        """The row of each of distinct hashes; make(which of them are new) gives (sizes, values) of each column."""
        rows = self._find(hashes)
        fresh = np.flatnonzero(rows < 0)
        if not len(fresh):
            return rows
        held = self.edges[0].n - 1
        if held and (held + len(fresh) > self.most or any(c.n > self.room for c in self.columns)):
            self.clear()
            rows, fresh, held = np.full(len(hashes), -1), np.arange(len(hashes)), 0
        for column, edges, (sizes, values) in zip(self.columns, self.edges, make(fresh), strict=True):
            edges.append(column.n + np.cumsum(sizes))
            column.append(values)
        rows[fresh] = held + np.arange(len(fresh))
        parts = [self.small, (hashes[fresh], rows[fresh])]
        if len(self.small[0]) + len(fresh) > len(self.large[0]) // 8:
            parts, self.large = [self.large, *parts], parts[0]
        keys, at = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        order = np.argsort(keys, kind="stable")
        if len(parts) == 3:
            self.large, self.small = (keys[order], at[order]), (keys[:0], at[:0])
        else:
            self.small = keys[order], at[order]
        return rows

    def get(self, column: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of the rows one after another, how many each has)."""
        return ragged(self.columns[column].values, self.edges[column].values, rows)


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct contents, ascending; a span of each; which content each span has)."""
    hashes = spans(prefixes(BYTE_VALUES[data]), starts, ends)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    codes = np.empty(len(order), np.int64)
    codes[order] = np.cumsum(fresh) - 1
    return ordered[fresh], order[fresh], codes


def read(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
