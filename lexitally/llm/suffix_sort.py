"""Sorting suffixes by hashes of their prefixes.

A suffix is a row of bytes with a length. Prefix polynomial hashes of all rows are made
once; the common extension of two suffixes is then found by binary search over the
length at which their hashes still agree, so comparing two suffixes takes a logarithmic
number of steps. A mergesort over these comparisons, each merge made for all elements of
all groups at once, puts every group in order. At the end all neighbours are compared
byte by byte: a hash collision shows up there and the sort is made again with another base.
"""

import numpy as np

PRIME = np.uint64((1 << 31) - 1)


def powers(base, n):
    """1, base, base^2, ... modulo PRIME."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = out[done - 1] * np.uint64(base) % PRIME
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step % PRIME
        done += more
    return out


def prefix_hashes(rows, seed=0):
    """(n, length + 1): hashes of all prefixes of byte rows, two polynomials modulo PRIME in one number."""
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
    rng = np.random.default_rng(seed)
    for _ in range(2):
        weight = powers(int(rng.integers(1 << 20, int(PRIME) - 1)), rows.shape[1])
        lane = np.cumsum((rows.astype(np.uint64) + np.uint64(1)) * weight % PRIME, axis=1) % PRIME
        out[:, 1:] = (out[:, 1:] << np.uint64(31)) | lane
    return out


def extensions(hashes, x, y, most):
    """How many first bytes the rows x[i] and y[i] share, at most most[i]."""
    low, high = np.zeros(len(x), np.int64), most.astype(np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) >> 1
        same = hashes[x, middle] == hashes[y, middle]
        low = np.where(open_ & same, middle, low)
        high = np.where(open_ & ~same, middle - 1, high)


def _before(rows, hashes, sizes, x, y):
    """-1, 0 or 1 as row x[i] comes before, is equal to or comes after row y[i]; what ends first comes first."""
    least = np.minimum(sizes[x], sizes[y])
    shared = extensions(hashes, x, y, least)
    ended = shared == least
    at = np.where(ended, 0, shared)
    differ = rows[x, at].astype(np.int64) - rows[y, at]
    return np.sign(np.where(ended, sizes[x] - sizes[y], differ))


def _merged(rows, hashes, sizes, order, start, size, at, run):
    """One level of the mergesort: neighbouring runs of `run` elements become one, inside each group."""
    place = at // run
    other = place ^ 1
    first = start + other * run
    last = np.minimum(first + run, start + size)
    busy = np.flatnonzero(first < last)
    low, high = first[busy].copy(), last[busy].copy()
    right = (place[busy] & 1).astype(np.int64)
    mine = order[busy]
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        middle = (low[open_] + high[open_]) >> 1
        after = _before(rows, hashes, sizes, order[middle], mine[open_]) < right[open_]
        low[open_] = np.where(after, middle + 1, low[open_])
        high[open_] = np.where(after, high[open_], middle)
    target = np.arange(len(order))
    begin = start[busy] + np.minimum(place[busy], other[busy]) * run
    target[busy] = begin + at[busy] % run + low - first[busy]
    out = np.full(len(order), -1)
    out[target] = order
    return None if (out < 0).any() else out  # collisions can make comparisons contradict each other


def sorted_suffixes(rows, sizes, groups):
    """Order of the rows inside each group (rows of a group lie together), and the bytes each shares with the one before, -1 at a group's start."""
    n = len(rows)
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if n else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, n))
    start, size = np.repeat(starts, counts), np.repeat(counts, counts)
    at = np.arange(n) - start
    sizes = sizes.astype(np.int64)
    for seed in range(64):
        hashes = prefix_hashes(rows, seed)
        order, run = np.arange(n), 1
        while order is not None and n and run < counts.max():
            order = _merged(rows, hashes, sizes, order, start, size, at, run)
            run *= 2
        if order is None:
            continue
        shared = np.full(n, -1, np.int64)
        inner = np.flatnonzero(at > 0)
        x, y = order[inner - 1], order[inner]
        least = np.minimum(sizes[x], sizes[y])
        shared[inner] = extensions(hashes, x, y, least)
        if _verified(rows, sizes, x, y, shared[inner], least):
            return order, shared
    raise ArithmeticError("hash collisions under every base")


def _verified(rows, sizes, x, y, shared, least):
    """Neighbours share exactly `shared` bytes and are in order."""
    for at in range(0, len(x), 1 << 14):
        part = slice(at, at + (1 << 14))
        a, b, n = rows[x[part]], rows[y[part]], shared[part]
        column = np.arange(rows.shape[1])
        if ((a != b) & (column < n[:, None])).any():
            return False
        ended = n == least[part]
        i = np.arange(len(n))[~ended]
        if (a[i, n[~ended]] >= b[i, n[~ended]]).any() or (sizes[x[part]][ended] > sizes[y[part]][ended]).any():
            return False
    return True
