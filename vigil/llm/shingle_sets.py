"""Shingle sets of texts as hashes, and the keys under which similar sets meet.

A link needs 100 * |A and B| >= percent * |A or B|. For sizes a <= b that is an
overlap of at least least_overlap(a, b), so at most a + b less twice that many
elements are in one set alone.

Small sets (both sizes up to a boundary): the overlap is a subset of that size of
both, so equal subsets of each size that can be asked for are keys.

Large sets: elements fall into blocks by hash, more blocks than there can be
single elements, so at least one block holds equal parts; the part of a block is
a key. (A single frequent element would list any number of documents; the equal
part of a block lists near copies.) Empty parts are keys only of sets with so few
filled blocks that all of them could differ. Sizes are ranged in classes, a pair
meets in the class of the larger set.
"""

import itertools
import math

import numpy as np
import xxhash

from vigil.llm.passages import Units, grams, spread

CLASS_RATIO = 1.5
#: Cost of a key that lists blocks, in keys of a subset: its entries are compared.
SCAN_COST = 4
FIRST_CLASS = 4
SALTS = np.random.default_rng(23).integers(1, 1 << 63, 64, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def least_overlap(a: int, b: int, percent: int) -> int:
    return -(-percent * (a + b) // (100 + percent))


def smallest_partner(b: int, percent: int) -> int:
    return -(-percent * b // 100)


def first_of_order(a: np.ndarray, percent: int) -> np.ndarray:
    """How many first elements of sets of sizes a, in any one order of all elements, hold one
    that each linked set has among its own: the first shared one has the rest of the overlap behind it."""
    return a - least_overlap(a, smallest_partner(a, percent), percent) + 1


class Sets:
    """Distinct shingles of many texts: hashes in order within each text."""

    def __init__(self, u: Units, width: int):
        words = np.diff(u.first)
        n = len(u.codes)
        owner = np.repeat(np.arange(len(words)), words)
        if n >= width:
            here = np.flatnonzero(owner[:n - width + 1] == owner[width - 1:])
            value, of = grams(u.codes, width)[here], owner[here]
        else:
            value, of = np.empty(0, np.uint64), np.empty(0, np.int64)
        # A text of fewer words is one shingle, told apart by its number of words.
        short = np.flatnonzero((words > 0) & (words < width))
        lone = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            some = words[short] > j
            lone[some] = mix(lone[some] + u.codes[u.first[:-1][short[some]] + j])
        value = np.concatenate([value, mix(lone + SALTS[words[short] % 64])])
        of = np.concatenate([of, short])
        order = np.lexsort((value, of))
        value, of = value[order], of[order]
        once = np.ones(len(value), bool)
        once[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
        self.values, self.owner = value[once], of[once]
        self.sizes = np.bincount(self.owner, minlength=len(words)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])

    def keys(self) -> list[bytes]:
        """128-bit key of each whole set."""
        raw = self.values.tobytes()
        return [xxhash.xxh3_128_digest(raw[8 * a:8 * b])
                for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist())]


class Keys:
    """Keys of sets under a similarity of percent, small sets up to boundary."""

    def __init__(self, percent: int, boundary: int):
        self.percent, self.boundary = percent, boundary

    @staticmethod
    def class_of(sizes: np.ndarray) -> np.ndarray:
        return np.maximum(0, np.ceil(np.log(np.maximum(sizes, 1) / FIRST_CLASS) / math.log(CLASS_RATIO) - 1e-9)
                          ).astype(np.int64)

    @staticmethod
    def class_top(c: np.ndarray) -> np.ndarray:
        """Largest size of a class."""
        return np.floor(FIRST_CLASS * CLASS_RATIO ** c.astype(float) + 1e-6).astype(np.int64)

    def single(self, a, b):
        """The most elements in one set alone of a linked pair of these sizes."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def blocks(self, c: np.ndarray) -> np.ndarray:
        """One more than single elements of the largest sets, and some that stay empty."""
        top = self.class_top(c)
        least = self.single(top, top) + 1
        empty = least * np.exp(-top / (least + 2.0))
        return least + 2 + np.ceil(empty + 4 * np.sqrt(empty)).astype(np.int64)

    def drops(self, a: int) -> list[int]:
        """How many elements the subsets of a small set of size a leave out."""
        first, last = smallest_partner(a, self.percent), 100 * a // self.percent
        return sorted({a - least_overlap(a, b, self.percent) for b in range(first, min(last, self.boundary) + 1)
                       if least_overlap(a, b, self.percent) <= min(a, b) and (b != a or
                           least_overlap(a, a, self.percent) < a)})

    def subset_cost(self, a: int) -> int:
        return sum(math.comb(a, d) for d in self.drops(a))

    def of(self, sets: Sets) -> tuple[np.ndarray, np.ndarray]:
        """(set, key) of every key of every set."""
        found = [*self._subsets(sets), *self._parts(sets)]
        return (np.concatenate([np.empty(0, np.int64), *(s for s, _ in found)]),
                np.concatenate([np.empty(0, np.uint64), *(k for _, k in found)]))

    def _subsets(self, sets: Sets):
        for a in np.unique(sets.sizes[(sets.sizes > 0) & (sets.sizes <= self.boundary)]).tolist():
            own = np.flatnonzero(sets.sizes == a)
            values = mix(sets.values[sets.first[own][:, None] + np.arange(a)])
            total = values.sum(axis=1)
            for d in self.drops(a):
                salt = mix(np.array([a - d], np.uint64) + SALTS[0])
                for some in _chunks(itertools.combinations(range(a), d), 4096):
                    left = np.array(some, np.int64).reshape(len(some), d)
                    kept = total[:, None] - values[:, left].sum(axis=2)
                    yield np.repeat(own, len(some)), mix(kept + salt).ravel()

    def _parts(self, sets: Sets):
        own = self.class_of(sets.sizes)
        # Wanted where the larger set of a pair can be beyond the boundary.
        wanted = (sets.sizes > 0) & (100 * sets.sizes >= self.percent * (self.boundary + 1))
        for shift in range(2 + int(math.log(100 / self.percent) / math.log(CLASS_RATIO))):
            c = own + shift
            # A set meets larger partners in the classes whose smallest size it reaches.
            reaches = 100 * sets.sizes >= self.percent * (self.class_top(c - 1) + 1) if shift else wanted
            some = np.flatnonzero(wanted & reaches & (self.class_top(c) > self.boundary))
            if len(some):
                yield from self._in_class(sets, some, c[some])

    def _in_class(self, sets: Sets, some: np.ndarray, c: np.ndarray):
        size, count = sets.sizes[some], self.blocks(c)
        values = mix(sets.values[spread(sets.first[some], size)])
        base = np.concatenate([[0], np.cumsum(count)])
        block = (values >> np.uint64(20)) % np.repeat(count, size).astype(np.uint64)
        slot = np.repeat(base[:-1], size) + block.astype(np.int64)
        order = np.argsort(slot, kind="stable")
        at = np.flatnonzero(np.concatenate([[True], np.diff(slot[order]) != 0]))
        sums = np.zeros(base[-1], np.uint64)
        sums[slot[order][at]] = np.add.reduceat(values[order], at)
        filled = np.zeros(base[-1], bool)
        filled[slot] = True
        owner = np.repeat(np.arange(len(some)), count)
        parts = np.bincount(owner[filled], minlength=len(some))
        partner = np.minimum(self.class_top(c), 100 * size // self.percent)
        emit = filled | (parts <= self.single(size, partner))[owner]
        number = (spread(np.zeros(len(some), np.int64), count) + c[owner] * 1_000_003).astype(np.uint64)
        key = mix(sums + mix(number + SALTS[1]) + np.where(filled, np.uint64(0), SALTS[2]))
        yield some[owner[emit]], key[emit]


def _chunks(items, size: int):
    items = iter(items)
    while some := list(itertools.islice(items, size)):
        yield some


def boundary_by_cost(counts: dict[int, int], percent: int, most: int = 64) -> int:
    """The largest size of small sets with the least cost of all keys; counts: sets by size."""
    best, chosen = None, 0
    for x in range(0, most + 1):
        keys = Keys(percent, x)
        cost = 0
        for a, n in counts.items():
            if a <= x:
                cost += n * keys.subset_cost(a)
            if a > x or 100 * a >= percent * (x + 1):
                cost += n * SCAN_COST * int(keys.blocks(keys.class_of(np.array([a])))[0])
            if cost and best is not None and cost > best:
                break
        if best is None or cost < best:
            best, chosen = cost, x
    return chosen
