"""Suffix arrays of many short texts at once, by linear grouping.

First phase: suffixes begin in one group per first byte. The groups of a text
are taken in descending order. For each suffix of the group its previous smaller
one is found: the nearest place to the left whose group is lower, reached over
the pointers of places passed before. Each place pointed to leaves its group for
a new one right behind it, by how many suffixes of the group point to it: its
known prefix grows by that many copies of theirs. When all groups were taken,
each holds the suffixes that share their longest Lyndon prefix.

Second phase: in ascending order, from the end of the text, each suffix places
the one before it, and over its previous-smaller pointers those further left, in
the next free slot of their groups. Nothing is renamed or sorted again.

Both phases advance all texts by one group, or one slot, per step.
"""

import numpy as np


def suffix_orders(text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Suffix array of each text, one after another, as places in text.

    text: the texts joined, as integers; each ends with a 0 that stands nowhere
    else in it. offsets: the begin of each text, and the end of the last.
    """
    group, pointer = _lyndon_groups(text, offsets)
    return _emit(group, pointer, offsets)


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[k], begin[k] + 1, ... for size[k] numbers each."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)


def _lyndon_groups(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place the first slot of its final group, and its previous smaller place or -1."""
    n = len(text)
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    key = owner.astype(np.int64) * (int(text.max(initial=0)) + 1) + text
    order = np.argsort(key, kind="stable")  # slot -> place
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    changes = np.flatnonzero(np.diff(key[order], prepend=-1))
    group = np.empty(n, np.int64)  # place -> first slot of its group
    group[order] = np.repeat(changes, np.diff(np.append(changes, n)))
    end = np.zeros(n, np.int64)  # first slot of a group -> slot after its last
    end[changes] = np.append(changes[1:], n)
    before = np.arange(-1, n - 1)
    before[offsets[:-1][sizes > 0]] = -1
    pointer = before

    low = offsets[:-1][sizes > 0].astype(np.int64)
    high = offsets[1:][sizes > 0].astype(np.int64)
    while len(high):
        first = group[order[high - 1]]
        members = order[_spread(first, high - first)]
        level = np.repeat(first, high - first)
        # Previous smaller places, all members of all texts together.
        to = pointer[members]
        pending = np.flatnonzero((to >= 0) & (group[to] >= level))
        while len(pending):
            to[pending] = pointer[to[pending]]
            pointer[members[pending]] = to[pending]
            there = to[pending]
            pending = pending[(there >= 0) & (group[there] >= level[pending])]
        # Places pointed to move to the end of their group, more often pointed to last.
        hit = np.sort(to[to >= 0])
        if len(hit):
            starts = np.flatnonzero(np.diff(hit, prepend=-1))
            place, times = hit[starts], np.diff(np.append(starts, len(hit)))
            old = group[place]
            by = np.lexsort((times, old))
            place, times, old = place[by], times[by], old[by]
            head = np.flatnonzero(np.diff(old, prepend=-1))
            count = np.diff(np.append(head, len(old)))
            tail = end[old[head]] - count
            target = _spread(tail, count)
            _swap(order, slot, place, target)
            new = np.diff(old, prepend=-1) != 0
            new |= np.diff(times, prepend=0) != 0
            at = np.flatnonzero(new)
            length = np.diff(np.append(at, len(old)))
            end[old[head]] = tail
            group[place] = np.repeat(target[at], length)
            end[target[at]] = target[at] + length
        going = first > low
        high, low = first[going], low[going]
    return group, pointer


def _swap(order: np.ndarray, slot: np.ndarray, place: np.ndarray, target: np.ndarray) -> None:
    """Put place[k] into slot target[k]; what stood there takes the slots that came free.

    The targets of a group are its last slots, so the places that have to leave
    them and the slots left by their new owners agree in number in each group,
    and both come in the order of the groups.
    """
    left = slot[place]
    stays = np.zeros(len(place), bool)
    by_slot = np.sort(left)
    at = np.searchsorted(by_slot, target)
    stays = (at < len(by_slot)) & (by_slot[np.minimum(at, len(by_slot) - 1)] == target)
    leaving = order[target[~stays]]
    targets = np.sort(target)
    at = np.searchsorted(targets, by_slot)
    free = by_slot[~((at < len(targets)) & (targets[np.minimum(at, len(targets) - 1)] == by_slot))]
    order[free], slot[leaving] = leaving, free
    order[target], slot[place] = place, target


def _emit(group: np.ndarray, pointer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(group)
    out = np.full(n, -1, np.int64)
    free = np.arange(n)  # first slot of a group -> its next free slot
    placed = np.zeros(n, bool)
    sizes = np.diff(offsets)
    low, high = offsets[:-1][sizes > 0].astype(np.int64), offsets[1:][sizes > 0].astype(np.int64)
    out[low], placed[high - 1] = high - 1, True  # the final 0 is the smallest suffix
    now, at = low.copy(), low
    while len(at):
        place = out[now] - 1
        going = place >= at
        place = place[going]
        while len(place):
            place = place[~placed[place]]
            own = group[place]
            # Places of different texts: no two share a group.
            to = free[own]
            out[to], free[own], placed[place] = place, to + 1, True
            place = pointer[place]
            place = place[place >= 0]
        now = now + 1
        more = now < high
        now, at, high = now[more], at[more], high[more]
    return out
