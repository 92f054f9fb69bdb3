"""Suffix arrays of packed passages by two-stage sorting, and their adjacent common prefixes.

Only suffixes that are smaller than their successor are sorted directly. The others follow by a scan over the buckets
of first bytes in order: a suffix that is larger than its successor comes, within the bucket of its first byte, in the
order in which the successors are met. Orders are exact to `depth` bytes, which is all that a comparison of prefixes
of that length needs.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 255


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For every suffix, whether it is smaller than the suffix that starts one byte later."""
    out = np.zeros(len(text), bool)
    change = np.flatnonzero(text[1:] != text[:-1])
    if len(change):  # all of a run of equal bytes is like its last byte
        out[:change[-1] + 1] = np.repeat(text[change] < text[change + 1], np.diff(change, prepend=-1))
    return out


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int, small: np.ndarray | None = None) -> np.ndarray:
    """The wanted suffixes in order of their first `depth` bytes.

    `wanted` marks places; a wanted suffix that is larger than its successor needs the successor wanted too.
    """
    small = smaller_than_next(text) if small is None else small
    direct = np.flatnonzero(wanted & small)
    data = text.tobytes()
    keys = [data[i:i + depth] for i in direct.tolist()]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    cuts = np.searchsorted(text[direct], np.arange(257))
    induced = wanted & ~small
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def before(places: np.ndarray) -> np.ndarray:
        places = places[places > 0] - 1
        return places[induced[places]]

    for byte in range(256):
        begun = [np.concatenate(waiting[byte])] if waiting[byte] else []
        while begun and len(begun[-1]):  # runs of this byte
            more = before(begun[-1])
            begun.append(more[text[more] == byte])
        bucket = np.concatenate([*begun, direct[cuts[byte]:cuts[byte + 1]]])
        out.append(bucket)
        earlier = before(bucket)
        firsts = text[earlier]
        earlier, firsts = earlier[firsts > byte], firsts[firsts > byte]
        by_byte = np.argsort(firsts, kind="stable")
        ends = np.flatnonzero(np.diff(firsts[by_byte])) + 1
        for group in np.split(earlier[by_byte], ends):
            if len(group):
                waiting[text[group[0]]].append(group)
    return np.concatenate(out).astype(np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix has in common with the one before it in order, up to `depth`; 0 for the first."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.ndarray((len(text) + 1,), "<u8", padded, strides=(1,))
    out = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for at in range(0, depth, 8):
        if not len(open_):
            break
        a, b = order[open_ - 1] + at, order[open_] + at
        inside = (a < len(text)) & (b < len(text))
        open_, a, b = open_[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        same = np.where(differ == 0, 8, (np.bitwise_count(~differ & (differ - np.uint64(1))) >> 3).astype(np.int64))
        out[open_] = at + same
        open_ = open_[differ == 0]
    return np.minimum(out, depth)


def later_windows(passages: list[bytes], windows: np.ndarray, rank: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of `width` bytes that also start earlier, as passage numbers and places in the passage.

    Passage i has windows at its first windows[i] places. A window is earlier if its passage has the smaller rank,
    or is the same passage and the place is smaller.
    """
    # The two bytes at the end make sure of a last suffix that is smaller than its successor.
    text = np.frombuffer(b"".join([*(p + bytes([SEPARATOR]) for p in passages), bytes([0, SEPARATOR])]), np.uint8)
    sizes = np.array([len(p) + 1 for p in passages], np.int64)
    base = np.cumsum(sizes) - sizes
    # What is induced needs its successors, up to one that is sorted directly.
    small = smaller_than_next(text)
    ends = np.flatnonzero(small)
    stop = ends[np.minimum(np.searchsorted(ends, base + windows - 1), len(ends) - 1)]
    mark = np.zeros(len(text) + 1, np.int64)
    np.add.at(mark, base, 1)
    np.add.at(mark, stop + 1, -1)
    order = suffix_order(text, np.cumsum(mark[:-1]) > 0, width, small)
    owner = np.searchsorted(base, order, side="right") - 1
    place = order - base[owner]
    held = place < windows[owner]
    order, owner, place = order[held], owner[held], place[held]
    starts = np.flatnonzero(common_prefixes(text, order, width) < width)
    if not len(order):
        return owner, place
    key = rank[owner] << 32 | place
    earliest = np.minimum.reduceat(key, starts)
    runs = np.diff(np.r_[starts, len(order)])
    later = key != np.repeat(earliest, runs)
    return owner[later], place[later]
