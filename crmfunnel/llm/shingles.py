"""Word shingles of whole texts as 64-bit hashes, and compact forms of sorted hashes."""

from __future__ import annotations

import numpy as np
import zstandard

#: Words of a shingle.
WORDS = 4


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype="u8") * np.uint64(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_PLACE = _mixed(np.arange(1001, 1001 + WORDS, dtype="u8")) | np.uint64(1)
_STEP = np.uint64(0xD1342543DE82EF95)


#: Bytes of text that are hashed at once; about 50 bytes of memory each.
AT_ONCE = 1 << 18


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after the other; and how many each has.

    A text with fewer words than a shingle has its whole sequence of words as one; one without words has none.
    """
    parts, begin, held = [], 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= AT_ONCE or i == len(texts) - 1:
            parts.append(_shingle_sets(texts[begin:i + 1]))
            begin, held = i + 1, 0
    return (np.concatenate([p[0] for p in parts] or [np.zeros(0, "u8")]),
            np.concatenate([p[1] for p in parts] or [np.zeros(0, "i8")]))


def _shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(texts) + b"\n", "u1")
    gap = _SEPARATOR[data]
    before = np.concatenate([[True], gap[:-1]])
    starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
    counts = np.zeros(len(texts), "i8")
    if not len(starts):
        return np.zeros(0, "u8"), counts
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), _STEP)
    powers[0] = 1
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(powers)
        words = _mixed(np.add.reduceat(_BYTE[data[~gap]] * powers[place], first))
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        owner = np.searchsorted(offsets, starts, side="right") - 1
        n_words = np.bincount(owner, minlength=len(texts))
        parts = [words * k for k in _PLACE]
        if len(words) >= WORDS:
            last = len(words) - WORDS + 1
            whole = owner[:last] == owner[WORDS - 1:]
            hashes = _mixed(sum((parts[j][j:last + j] for j in range(1, WORDS)), parts[0][:last]))[whole]
            owners = owner[:last][whole]
        else:
            hashes, owners = np.zeros(0, "u8"), np.zeros(0, "i8")
        short = np.flatnonzero((n_words > 0) & (n_words < WORDS))
        if len(short):
            begin = np.cumsum(n_words) - n_words
            own = [_mixed(np.array([sum(int(parts[j][begin[d] + j]) for j in range(n_words[d])) + int(n_words[d])
                                    & 0xFFFFFFFFFFFFFFFF], "u8"))[0] for d in short]
            hashes, owners = np.concatenate([hashes, np.array(own, "u8")]), np.concatenate([owners, short])
            order = np.argsort(owners, kind="stable")
            hashes, owners = hashes[order], owners[order]
    sizes = np.bincount(owners, minlength=len(texts))
    edges = np.concatenate([[0], np.cumsum(sizes)])
    hashes = np.ascontiguousarray(hashes)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        hashes[a:b].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[keep], np.bincount(owners[keep], minlength=len(texts))


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Two 64-bit sums per set, as signed numbers: equal sets, and in practice only those, have equal sums."""
    out = np.zeros((len(counts), 2), "u8")
    full = counts > 0
    if full.any():
        first = (np.cumsum(counts) - counts)[full]
        with np.errstate(over="ignore"):
            for i, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
                out[full, i] = np.add.reduceat(_mixed(hashes ^ np.uint64(salt)), first)
    return out.view("i8")


def squeezed(x: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes, plane by plane: high planes are nearly empty."""
    planes = x.astype("<u8").view("u1").reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def spread(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1")
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel()
