"""Numpy helpers of ``ranges``: a window's templates as blocks of whole numbers, and the pairs that one block holds.

Values become ranks, so the tolerance is a run of ranks and only whole numbers are compared. Templates are sorted by their first
value: those near one of them are a run of positions. A run is cut into aligned blocks of positions that double in size
(``cover``); within a block sorted by the next value the near ones are a run again, and in the last value a run is
counted bit by bit of the ranks (``_between``). For three values that is n log² n steps, however many pairs there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Points of a block that are compared with all who ask, points of the smallest block of a larger one, and comparisons at once.
LEAST, WIDE, AT_ONCE = 1024, 256, 1 << 16


def near_ranks(u, r) -> tuple:
    """For each of the sorted values ``u``, the first that is closer than ``r``, as that comparison rounds, and the one behind the last.

    A value that isn't close to itself (it is infinite, or ``r`` is not a number) has none.
    """
    at = np.arange(len(u))
    with np.errstate(invalid="ignore"):
        close = lambda k: np.abs(u - u[np.clip(k, 0, len(u) - 1)]) < r
        lo, hi = np.minimum(np.searchsorted(u, u - r), at), np.maximum(np.searchsorted(u, u + r, "right"), at + 1)
        own = close(at)
        while (move := own & (lo > 0) & close(lo - 1)).any():
            lo -= move
        while (move := own & ~close(lo)).any():
            lo += move
        while (move := own & (hi < len(u)) & close(hi)).any():
            hi += move
        while (move := own & ~close(hi - 1)).any():
            hi -= move
    return np.where(own, lo, at), np.where(own, hi, at)


def cover(lo, hi, size: int) -> Iterator[tuple]:
    """Cuts the runs lo <= p < hi at blocks of ``size`` positions, then takes the blocks in between, at most two of each doubled size.

    Per size: the size, which run a piece is of, its block, and its ends.
    """
    which = np.flatnonzero(lo < hi)
    lo, hi = lo[which], hi[which]
    a, b = lo // size, hi // size
    end = b * size < hi
    start = ~(end & (a == b))
    yield (size, np.r_[which[start], which[end]], np.r_[a[start], b[end]],
           np.r_[lo[start], np.maximum(lo, b * size)[end]], np.r_[np.minimum(hi, (a + 1) * size)[start], hi[end]])
    a = a + 1
    while (left := a < b).any():
        which, a, b = which[left], a[left], b[left]
        odd = a % 2 == 1
        last = (a + odd < b) & (b % 2 == 1)
        block = np.r_[a[odd], b[last] - 1]
        yield size, np.r_[which[odd], which[last]], block, block * size, (block + 1) * size
        a, b, size = (a + odd) // 2, b // 2, 2 * size


def _of_each(block) -> Iterator[tuple]:
    """Each block and the places that name it."""
    order = np.argsort(block, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
        if len(places):
            yield int(block[places[0]]), places


def window_blocks(xs, r, m: int, most: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Blocks of the templates of ``xs``; with the first, the pairs of equal templates (all ``m + 1`` values, and the first ``m``).

    A block of ``most`` positions or more has its points, with count and ranks, and who asks for some of them: count, first position
    and the one behind the last, and the ends of the near ranks of each further value. Each other pair is in one block, once.
    """
    u, rank = np.unique(xs, return_inverse=True)
    lo, hi = (x.astype(np.int32) for x in near_ranks(u, r))
    n = len(xs) - m
    t = np.stack([rank[k:n + k] for k in range(m + 1)]).astype(np.int32)
    t = t[:, np.lexsort(t[::-1])]
    new = np.append(True, (t[:, 1:] != t[:, :-1]).any(axis=0))
    t, c = t[:, new], np.diff(np.append(np.flatnonzero(new), n))
    own = [int(np.where((lo < hi)[t[:k]].all(axis=0), c * c, c).sum()) for k in (m + 1, m)]
    points = np.stack([c, *t[1:]]).astype(np.int32)
    asks = np.stack([c, *[x[k] for k in t[1:] for x in (lo, hi)]]).astype(np.int32)
    for size, which, block, first, last in cover(np.arange(1, len(c) + 1), np.searchsorted(t[0], hi[t[0]]), most):
        for j, of in _of_each(block):
            places, asked = np.stack([first[of], last[of]]) - j * size, asks[:, which[of]]
            yield *own, points[:, j * size:(j + 1) * size].tobytes(), np.concatenate([asked[:1], places.astype(np.int32), asked[1:]]).tobytes()
            own = 0, 0
    if any(own):
        yield *own, b"", b""


def block_pairs(points: bytes, asked: bytes, m: int) -> tuple[int, int]:
    """Pairs of a block that match in all values, and in all but the last."""
    if not asked:
        return 0, 0
    c, *ranks = np.frombuffer(points, np.int32).reshape(m + 1, -1)
    w, lo, hi, *near = np.frombuffer(asked, np.int32).reshape(2 * m + 3, -1)
    a, b = _counted(c.astype(np.int64), ranks, w.astype(np.int64), lo.astype(np.int64), hi.astype(np.int64), [*zip(near[::2], near[1::2])])
    return int(a), int(b)


def _counted(c, ranks, w, lo, hi, near):
    """Weights ``w`` times counts ``c`` of the points lo <= p < hi whose ranks are all ``near``, and all but the last of them."""
    if len(ranks) == 1:
        sums = np.append(0, np.cumsum(c))
        return np.array([_between(c, ranks[0], w, lo, hi, *near[0]), (w * (sums[hi] - sums[lo])).sum()])
    if len(c) <= LEAST:
        return _compared(c, ranks, w, lo, hi, near)
    total, most = np.zeros(2, np.int64), int(ranks[0].max()) + 1
    for piece, (size, which, block, first, last) in enumerate(cover(lo, hi, WIDE)):
        if piece == 0:  # parts of blocks
            for j, of in _of_each(block):
                here, who = slice(j * size, (j + 1) * size), which[of]
                total += _compared(c[here], [x[here] for x in ranks], w[who], first[of] - j * size, last[of] - j * size, _picked(near, who))
            continue
        key = np.arange(len(c)) // size * (most + 1) + ranks[0]  # blocks in turn, each by the next value
        order = np.argsort(key)
        key, (ends, *rest) = key[order], _picked(near, which)
        first, last = (np.searchsorted(key, block * (most + 1) + np.minimum(x, most)) for x in ends)
        total += _counted(c[order], [x[order] for x in ranks[1:]], w[which], first, last, rest)
    return total


def _picked(near, which) -> list[tuple]:
    return [(low[which], high[which]) for low, high in near]


def _compared(c, ranks, w, lo, hi, near):
    """``_counted`` by comparing every point with all who ask, ``AT_ONCE`` pairs at a time."""
    runs = [(np.arange(len(c)), lo, hi), *[(x, *ends) for x, ends in zip(ranks, near)]]
    small = max(len(c), *[int(ends.max(initial=0)) for _, _, ends in runs]) < 1 << 16
    runs = [tuple(x.astype(np.uint16 if small else np.uint32) for x in run) for run in runs]  # a difference below 0 is a large one
    out, alone, step = [0, 0], (c == 1).all(), max(1, AT_ONCE // len(c))
    for at in range(0, len(w), step):
        s, met = slice(at, at + step), np.True_
        for left, (x, low, high) in enumerate(runs, 1 - len(runs)):
            met = met & (x - low[s, None] < (high[s] - low[s])[:, None])
            if left > -2:
                out[-left] += (w[s] * (np.count_nonzero(met, axis=1) if alone else np.where(met, c, 0).sum(axis=1))).sum()
    return np.array(out)


def _between(c, v, w, lo, hi, low, high):
    """Weights ``w`` times counts ``c`` of the points lo <= p < hi with low <= v < high.

    Points are dealt by the highest bit of ``v``, zeros first, then by the next, each keeping its order, so a run stays one
    run. Where the bit of a limit is set, the zeros of its run lie below the limit, and the ones go on; else the zeros go on.
    """
    total, most = 0, int(v.max(initial=-1)) + 1
    w, limit, lo, hi = np.append(w, -w), np.minimum(np.append(high, low), most), np.append(lo, lo), np.append(hi, hi)
    for bit in reversed(range(most.bit_length())):
        there = lo < hi
        if np.count_nonzero(there) < 0.8 * len(there):
            w, limit, lo, hi = w[there], limit[there], lo[there], hi[there]
        zero, up = v >> bit & 1 == 0, limit >> bit & 1 == 1
        order = np.append(np.flatnonzero(zero), np.flatnonzero(~zero))
        zeros, v, c = np.append(0, np.cumsum(zero)), v[order], c[order]
        sums, z_lo, z_hi = np.append(0, np.cumsum(c)), zeros[lo], zeros[hi]
        total += (w * up * (sums[z_hi] - sums[z_lo])).sum()
        lo, hi = np.where(up, zeros[-1] + lo - z_lo, z_lo), np.where(up, zeros[-1] + hi - z_hi, z_hi)
    return total
