"""Two-stage suffix sorting of one block of short texts, and the strings that repeat in it.

Stage one sorts directly only the suffixes that are smaller than their successors. Stage two induces
the others by a scan over the buckets of first bytes: each suffix met puts its predecessor, if that is
larger than it, at the end of what its bucket holds so far. The scan takes a bucket's entries at once, and
its own new entries again until none comes. Both stages order suffixes by their first ``DEPTH`` bytes at
least, which is all that strings of at most ``DEPTH`` bytes need.
"""

from __future__ import annotations

import numpy as np

#: Never found in UTF-8; it ends each text of a block.
SEPARATOR = 0xFF
DEPTH = 56


def words_at(block: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number, most significant first; zeros follow the end."""
    out = np.concatenate([block, np.zeros(DEPTH + 8, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        out = out[:-width] << np.uint64(8 * width) | out[width:]
    return out


def smaller_than_next(block: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is not, as the empty suffix is smallest."""
    n = len(block)
    step = np.sign(block[1:].astype(np.int16) - block[:-1].astype(np.int16))
    step = np.append(step, -1)
    # An equal next byte leaves the decision to the next place where the byte changes.
    at = np.where(step != 0, np.arange(n), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return step[at] > 0


def suffix_array(block: np.ndarray, words: np.ndarray | None = None, wanted: np.ndarray | None = None) -> np.ndarray:
    """Positions of all suffixes, in order of their first DEPTH bytes. With ``wanted``, a mask of positions, only of those and of the few that their order is induced from."""
    n = len(block)
    if not n:
        return np.zeros(0, np.int64)
    words = words_at(block) if words is None else words
    small = smaller_than_next(block)
    needed = np.ones(n, bool)
    if wanted is not None:
        # From a wanted place on, up to the next suffix that is sorted directly.
        direct_at = np.minimum.accumulate(np.where(small, np.arange(n), n - 1)[::-1])[::-1]
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, np.flatnonzero(wanted), 1)
        np.add.at(edges, direct_at[wanted] + 1, -1)
        needed = np.cumsum(edges)[:-1] > 0
    direct = np.flatnonzero(small & needed)
    direct = direct[np.lexsort([words[direct + 8 * k] for k in reversed(range(DEPTH // 8))])]
    bounds = np.searchsorted(block[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    # The empty suffix comes first of all, and the last suffix is larger than it.
    if needed[n - 1]:
        induced[block[n - 1]].append(np.array([n - 1]))
    order: list[np.ndarray] = []

    def induce(scanned: np.ndarray, bucket: int) -> np.ndarray:
        """Put the larger predecessors into their buckets; those of the bucket itself come back."""
        before = scanned[scanned > 0] - 1
        before = before[~small[before] & needed[before]]
        first = block[before]
        own = before[first == bucket]
        rest, first = before[first != bucket], first[first != bucket]
        if len(rest):
            by = np.argsort(first, kind="stable")
            rest, first = rest[by], first[by]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part, b in zip(np.split(rest, cuts), first[np.concatenate([[0], cuts])], strict=True):
                induced[b].append(part)
        return own

    for bucket in range(256):
        scanned = np.concatenate(induced[bucket]) if induced[bucket] else np.zeros(0, np.int64)
        while len(scanned):
            order.append(scanned)
            scanned = induce(scanned, bucket)
        rest = direct[bounds[bucket] : bounds[bucket + 1]]
        if len(rest):
            order.append(rest)
            induce(rest, bucket)
    return np.concatenate(order) if order else np.zeros(0, np.int64)


def common_prefixes(order: np.ndarray, words: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix in order shares with the one before it, up to ``most``; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    a, b = order[:-1], order[1:]
    open_ = np.ones(len(a), bool)
    for start in range(0, most, 8):
        x = words[a + start] ^ words[b + start]
        equal = x == 0
        # Where words differ, the first byte that does is the highest one set.
        bytes_ = np.where(equal, 8, 0)
        for k in range(8):
            bytes_ += (~equal & (x >> np.uint64(8 * (7 - k)) == 0)).astype(np.int64)
        out[1:] += np.where(open_, bytes_, 0)
        open_ &= equal
    return np.minimum(out, most)


def repeated_starts(texts: list[bytes], owners: np.ndarray, length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each text, the places where a string of ``length`` bytes starts that a text of a smaller owner holds too, and the places of the other strings."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    block = np.frombuffer(b"".join(t + bytes([SEPARATOR]) for t in texts), np.uint8)
    words = words_at(block)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    order = suffix_array(block, words, np.arange(len(block)) + length < (starts + sizes)[text_of])
    whole = order + length < (starts + sizes)[text_of[order]]
    # Strings with a separator are nobody's; between equal strings there are none of them.
    order = order[whole]
    groups = np.cumsum(common_prefixes(order, words, length) < length) - 1
    if not len(order):
        return _by_text(order, text_of, starts), _by_text(order, text_of, starts)
    owner = owners[text_of[order]]
    heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    least = np.repeat(np.minimum.reduceat(owner, heads), np.diff(np.append(heads, len(order))))
    return _by_text(order[owner > least], text_of, starts), _by_text(order[owner == least], text_of, starts)


def covered_starts(texts: list[bytes], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """The first of ``repeated_starts``."""
    return repeated_starts(texts, owners, length)[0]


def _by_text(places: np.ndarray, text_of: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Places in a block as sorted places in each of its texts."""
    places = np.sort(places)
    bounds = np.searchsorted(text_of[places], np.arange(len(starts) + 1))
    return [places[a:b] - start for a, b, start in zip(bounds[:-1].tolist(), bounds[1:].tolist(), starts.tolist(), strict=True)]
