"""Suffix arrays of one shard, in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

_FIRST = 8
#: Lanes of the walk: a step costs some twenty calls of numpy, whatever the number of lanes.
_LANES = 1 << 15


def words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number; the text is followed by zeros."""
    padded = np.concatenate([data, np.zeros(_FIRST, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for at in range(_FIRST):
        out = (out << np.uint64(8)) | padded[at : at + len(data)]
    return out


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` bytes, and each suffix's place. Suffixes that agree in so many
    bytes keep a common group; a shorter suffix comes before its extensions.

    A group's number is the place of its first member. Each round doubles the sorted length: members of a group are
    sorted by the group of the suffix that lies the sorted length further on, and groups of one are left alone.
    """
    n = len(data)
    order = np.argsort(words8(data), kind="stable").astype(np.int32)
    first = words8(data)[order]
    head = np.r_[True, first[1:] != first[:-1]]
    del first
    group = np.zeros(n + 1, np.int32)  # one past the end: before everything
    group[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0)).astype(np.int32) + 1
    sorted_to = _FIRST
    while sorted_to < depth:
        step = min(sorted_to, depth - sorted_to)
        lone = head & np.r_[head[1:], True]
        slots = np.flatnonzero(~lone)
        if not len(slots):
            break
        members = order[slots]
        follow = group[np.minimum(members.astype(np.int64) + step, n)]
        key = (group[members].astype(np.int64) << 32) | follow
        by_key = np.argsort(key, kind="stable")
        order[slots], key = members[by_key], key[by_key]
        fresh = np.r_[True, key[1:] != key[:-1]]
        head[slots] = fresh
        group[order[slots]] = np.maximum.accumulate(np.where(fresh, slots, 0)).astype(np.int32) + 1
        sorted_to += step
    place = np.zeros(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    return order, place


def _equal_bytes(difference: np.ndarray) -> np.ndarray:
    """Leading equal bytes of two big-endian words, from their exclusive or (not zero)."""
    out, rest = np.zeros(len(difference), np.int64), difference
    for shift, gain in ((32, 4), (16, 2), (8, 1)):
        upper = rest >> np.uint64(shift)
        equal = upper == 0
        out += equal * gain
        rest = np.where(equal, rest, upper) if shift > 8 else rest
    return out


def common_prefixes(data: np.ndarray, order: np.ndarray, place: np.ndarray, cap: int) -> np.ndarray:
    """Bytes that each suffix, in sorted order, has in common with the one before it, up to ``cap``.

    Kasai's walk goes through the text and loses at most one byte from a suffix to the next. Here many lanes walk
    at once, each through a stretch of its own. Where suffixes agree in full depth their order says nothing about the
    next ones; there the walk starts anew unless the next ones do lie in that order.
    """
    n = len(data)
    lanes = max(1, min(_LANES, n // 64))
    stretch = -(-n // lanes)
    eight = np.concatenate([words8(data), np.zeros(cap + _FIRST, np.uint64)])
    shared, at = np.zeros(n, np.int16), np.arange(lanes, dtype=np.int64) * stretch
    common, last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    for step in range(stretch):
        here = at + step
        live = np.flatnonzero(here < n)
        here = here[live]
        before = place[here].astype(np.int64) - 1
        kept = place[np.minimum(last[live] + 1, n - 1)] <= before
        held = np.where(kept & (before >= 0), np.maximum(common[live] - 1, 0), 0)
        there = order[np.maximum(before, 0)].astype(np.int64)
        going = np.flatnonzero((before >= 0) & (held < cap))
        while len(going):
            difference = eight[here[going] + held[going]] ^ eight[there[going] + held[going]]
            same = difference == 0
            stop = going[~same]
            held[stop] += _equal_bytes(difference[~same])
            going = going[same]
            held[going] += _FIRST
            going = going[held[going] < cap]
        held = np.minimum(held, np.minimum(cap, n - np.maximum(here, there)))
        common[live], last[live] = held, there
        shared[place[here]] = held
    return shared
