"""Enhanced suffix arrays of short segments and the tree of their common-prefix intervals.

A task sorts the suffixes of the segments of its buckets, takes the common prefix of each
with the next one, and scans that array with a stack: an interval is a run of suffixes that
share a prefix longer than what they share with those around it.  An interval whose
suffixes do not all follow the same byte is a maximal repeat; one that they do is part of
the longer repeat that starts a byte earlier, and is left out.
"""

from __future__ import annotations

import numpy as np

NONE, MANY = -1, -2  # the byte before a suffix: none in its segment; several in an interval


def _keys(data: np.ndarray, at: np.ndarray, least: int) -> list[np.ndarray]:
    """The first ``least`` bytes from each ``at`` as numbers that sort as the bytes do."""
    padded = np.append(data, np.zeros(8, dtype=np.uint8)).astype(np.uint64)
    eight = np.zeros(len(data) + 1, dtype=np.uint64)
    for i in range(8):
        eight = (eight << np.uint64(8)) | padded[i : i + len(eight)]
    if least < 8:
        return [eight[at] >> np.uint64(8 * (8 - least))]
    return [eight[at + i] for i in range(0, least - 7, 8)] + ([eight[at + least - 8]] if least % 8 else [])


def sorted_suffixes(
    data: np.ndarray, start: np.ndarray, stop: np.ndarray, bucket: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, segment, lcp): suffixes of ``least`` bytes or more in the order of bucket
    and bytes, without those that share no ``least`` bytes with another of their bucket.

    Segment i is ``data[start[i]:stop[i]]``; lcp is the common prefix with the suffix before
    (0: it shares no ``least`` bytes with it)."""
    count = np.maximum(stop - start - least + 1, 0)
    segment = np.repeat(np.arange(len(start)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + start[segment]
    if not len(at):
        return at, segment, at
    keys = _keys(data, at, least)
    order = np.lexsort([*keys[::-1], bucket[segment]])
    same = bucket[segment[order[1:]]] == bucket[segment[order[:-1]]]
    for k in keys:
        same &= k[order[1:]] == k[order[:-1]]
    shared = np.append(False, same) | np.append(same, False)
    same, order = np.append(False, same)[shared], order[shared]
    at, segment, group = at[order], segment[order], np.cumsum(~same)
    rest = int((stop[segment] - at).max() - least) if len(at) else 0
    if rest > 0:  # beyond the bytes shared: by the bytes that follow, a shorter one first
        inside = at[:, None] + least + np.arange(rest) < stop[segment][:, None]
        after = np.where(inside, data[np.minimum(at[:, None] + least + np.arange(rest), len(data) - 1)].astype(np.int16) + 1, 0)
        wide = after.astype(np.uint16)
        pad = -rest % 4
        if pad:
            wide = np.pad(wide, ((0, 0), (0, pad)))
        packed = np.ascontiguousarray(wide.astype(">u2")).view(">u8").astype(np.uint64)
        order = np.lexsort([*packed.T[::-1], group])
        at, segment, after = at[order], segment[order], after[order]
        equal = np.zeros(len(at), dtype=np.int64)
        differ = (after[1:] != after[:-1]) | (after[1:] == 0)
        equal[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rest)
        lcp = np.where(same, least + equal, 0)
    else:
        lcp = np.where(same, least, 0)
    return at, segment, lcp


def maximal_intervals(lcp: np.ndarray, before: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, first, last) of every interval of the suffix array with a common prefix of
    ``least`` or more whose suffixes differ in the byte ``before`` them (NONE differs from
    all, itself included)."""
    out: list[tuple[int, int, int]] = []
    n = len(lcp)
    heads = np.flatnonzero(lcp == 0)
    sizes = np.diff(np.append(heads, n))
    pairs = heads[sizes == 2]  # the commonest case at once
    left, right = before[pairs], before[pairs + 1]
    pairs = pairs[(left != right) | (left == NONE)]
    out += list(zip(lcp[pairs + 1].tolist(), pairs.tolist(), (pairs + 1).tolist()))
    for head, size in zip(heads[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        near, byte = lcp[head : head + size].tolist(), before[head : head + size].tolist()
        stack: list[list[int]] = []  # [length, first, the byte before, of what is in so far]
        for i in range(1, size + 1):
            shared = near[i] if i < size else 0
            first, seen = i - 1, byte[i - 1] if byte[i - 1] != NONE else MANY
            while stack and stack[-1][0] > shared:
                length, first, known = stack.pop()
                seen = known if known == seen else MANY
                if seen == MANY:
                    out.append((length, head + first, head + i - 1))
            if shared < least:
                continue
            if stack and stack[-1][0] == shared:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == seen else MANY
            else:
                stack.append([shared, first, seen])
    return out
