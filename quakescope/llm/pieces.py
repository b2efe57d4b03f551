"""A task's store of encoded pieces: each distinct piece of text is encoded once."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable

import numpy as np

#: Distinct pieces kept by a worker process; a full store is emptied.
CACHE = 300_000


class _Numbers(dict):
    """piece -> number of its entry; unknown pieces are noted, to be encoded together."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, piece: Hashable) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number


class _Grown:
    """An array that is added to at its end; room doubles, so that adding costs what is added."""

    def __init__(self, kind: type):
        self.room, self.used = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        end = self.used + len(values)
        if end > len(self.room):
            self.room = np.concatenate([self.room[: self.used], np.zeros(max(end, 2 * len(self.room)) - self.used, self.room.dtype)])
        self.room[self.used : end] = values
        self.used = end


class PieceStore:
    def __init__(self, encode: Callable[[list], Iterable[list[int]]], most: int = CACHE):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.begin, self.size, self.pool = _Grown(np.int64), _Grown(np.int64), _Grown(np.uint32)
        for grown, value in ((self.begin, 0), (self.size, 1), (self.pool, 0)):  # entry 0 is the id ``last``
            grown.add(np.array([value], grown.room.dtype))

    def lookup(self) -> _Numbers:
        """piece -> number, for the look-ups until the next ``gather``."""
        if len(self.numbers) > self.most:
            self._clear()
        return self.numbers

    def gather(self, numbers: np.ndarray, last: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered pieces end to end, and each piece's count; number -1 is the one id ``last``."""
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if fresh:
            found = list(self.encode(fresh))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.begin.add(self.pool.used + np.cumsum(sizes) - sizes)
            self.size.add(sizes)
            self.pool.add(np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum())))
        self.pool.room[0] = last
        size = self.size.room[numbers + 1]
        return self.pool.room[ranges(self.begin.room[numbers + 1], size)], size


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each row, ``size`` numbers a row."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each of the runs of ``counts`` values."""
    total, edge = np.r_[0, np.cumsum(values)], np.r_[0, np.cumsum(counts)]
    return total[edge[1:]] - total[edge[:-1]]
