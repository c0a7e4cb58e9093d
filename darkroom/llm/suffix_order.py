"""Deep-shallow ordering of many short byte strings, in groups, with LCPs.

Strings are rows of a matrix of big-endian 64-bit words. Rows of a group are
first ordered by multikey quicksort to a shallow depth: one word at a time,
only runs that still tie are partitioned again. Runs that tie beyond that
depth, the long common prefixes, are ordered as blind tries: every row of a
run is compared once with the run's first row; the place of the first
difference and the byte there decide its branch, without looking at the bytes
between. Branches with several rows are tries of their own.

All runs of all groups advance together, one array operation per step.
"""

from __future__ import annotations

import numpy as np

#: Words (of eight bytes) that the multikey quicksort looks at.
SHALLOW_WORDS = 4


def to_words(rows: np.ndarray) -> np.ndarray:
    """Bytes (n, width) as big-endian words (n, width / 8), zero-filled."""
    n, width = rows.shape
    if width % 8:
        rows = np.concatenate([rows, np.zeros((n, 8 - width % 8), np.uint8)], axis=1)
    return np.ascontiguousarray(rows).view(">u8").astype(np.uint64)


def common_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix, in bytes, of rows of words."""
    n, words = a.shape
    if n == 0:
        return np.zeros(0, np.int64)
    differ = a != b
    at = differ.argmax(axis=1)
    every = np.arange(n)
    same = ~differ[every, at]
    x = a[every, at] ^ b[every, at]
    lead = np.zeros(n, np.int64)
    for shift in (32, 16, 8):
        high = (x >> np.uint64(64 - shift)) == 0
        lead += np.where(high, shift // 8, 0)
        x = np.where(high, x << np.uint64(shift), x)
    return np.where(same, 8 * words, 8 * at + lead)


def branch_byte(words: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    at = np.minimum(at, 8 * words.shape[1] - 1)
    return (words[rows, at >> 3] >> (np.uint64(56) - (at & 7).astype(np.uint64) * np.uint64(8))) & np.uint64(255)


def deep_shallow_order(words: np.ndarray, group: np.ndarray, shallow: int = SHALLOW_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): an order of the rows in which groups are consecutive and,
    at every depth, rows with equal prefixes are consecutive within a group;
    lcp[i] is the common prefix of order[i - 1] and order[i] in bytes, -1 where
    a group begins."""
    n, width = words.shape
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(group, kind="stable")
    run = np.concatenate(([0], np.cumsum(group[order][1:] != group[order][:-1])))
    tied = np.arange(n)  # places whose run has several rows
    for depth in range(min(shallow, width)):
        tied = tied[in_runs(run[tied])]
        if not len(tied):
            break
        key = words[order[tied], depth]
        by = np.lexsort((key, run[tied]))
        order[tied] = order[tied][by]
        run = split_runs(run, tied, key[by])
    while True:
        tied = tied[in_runs(run[tied])]
        if not len(tied):
            break
        r = run[tied]
        first = np.concatenate(([True], r[1:] != r[:-1]))
        head = order[tied[first]][np.cumsum(first) - 1]
        rows = order[tied]
        same = common_bytes(words[rows], words[head])
        whole = same >= 8 * width  # equal to the head: ends its trie here
        key = np.where(whole, 0, branch_byte(words, rows, same).astype(np.int64) + 1)
        by = np.lexsort((key, -same, r))
        order[tied] = rows[by]
        combined = (8 * width - same[by]) * 300 + key[by]
        run = split_runs(run, tied, combined)
        # the head's own branch and copies of it are done
        tied = tied[~whole[by]]
    lcp = np.full(n, -1, np.int64)
    same_group = group[order][1:] == group[order][:-1]
    at = np.flatnonzero(same_group) + 1
    lcp[at] = common_bytes(words[order[at - 1]], words[order[at]])
    return order, lcp


def in_runs(run: np.ndarray) -> np.ndarray:
    """Of consecutive run numbers, which belong to a run of several rows."""
    if not len(run):
        return np.zeros(0, bool)
    same = run[1:] == run[:-1]
    return np.concatenate(([False], same)) | np.concatenate((same, [False]))


def split_runs(run: np.ndarray, places: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Run numbers after the runs at `places` were split where `key` changes."""
    breaks = np.zeros(len(run), np.int64)
    breaks[1:] = run[1:] != run[:-1]
    if len(places) > 1:
        breaks[places[1:][(places[1:] == places[:-1] + 1) & (key[1:] != key[:-1])]] = 1
    return np.cumsum(breaks)


def window_matches(left: np.ndarray, right: np.ndarray, left_size: np.ndarray, right_size: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For anchors with text to the left (reversed, nearest byte first) and to
    the right of them, padded with zeros that no text byte equals: the least
    and the greatest offset o (-1 if none) such that the string of `length`
    bytes that starts o bytes before the anchor equals that of another anchor
    of the same group."""
    n = len(group)
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    if n < 2:
        return low, high
    sides = []
    for data, size in ((left, left_size), (right, right_size)):
        order, lcp = deep_shallow_order(to_words(data), group)
        inside = lcp >= 0
        inside[0] = False
        at = np.flatnonzero(inside)
        lcp[at] = np.minimum(lcp[at], np.minimum(size[order[at - 1]], size[order[at]]))
        best = np.maximum(lcp, np.concatenate((lcp[1:], [-1])))
        reach = np.empty(n, np.int64)
        reach[order] = best
        sides.append((order, lcp, reach))
    (left_order, left_lcp, left_reach), (right_order, right_lcp, right_reach) = sides
    places = np.arange(n)
    for o in range(left.shape[1] + 1):
        rows = np.flatnonzero((left_reach >= o) & (right_reach >= length - o))
        if len(rows) < 2:
            continue
        keys = []
        for order, lcp, depth in ((left_order, left_lcp, o), (right_order, right_lcp, length - o)):
            start = np.maximum.accumulate(np.where(lcp < depth, places, 0))
            of = np.empty(n, np.int64)
            of[order] = start
            keys.append(of[rows])
        _, which, count = np.unique(keys[0] * np.int64(n) + keys[1], return_inverse=True, return_counts=True)
        hit = rows[count[which] > 1]
        low[hit] = np.where(low[hit] < 0, o, low[hit])
        high[hit] = o
    return low, high
