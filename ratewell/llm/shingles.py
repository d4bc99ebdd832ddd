"""Hashed word shingles of whole texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

#: Words of a shingle.
WIDTH = 5
#: Bytes of text that are hashed at a time; numpy holds about 60 bytes for each of them.
CHUNK = 1 << 19
ODD, ODD_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
STEP = 0xC2B2AE3D27D4EB4F


def mix(x):
    """Spread each 64-bit value over all its bits; equal values stay equal, others differ."""
    import numpy as np

    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def shingle_blocks(texts: list[str], width: int = WIDTH) -> Iterator[tuple]:
    """For blocks of texts ``(first text, hashes, owner)``: a 64-bit hash per shingle, and its text counted
    from the block's first, ascending.

    Words are runs of letters a-z (A-Z lower-cased), digits and non-ASCII characters. A text of
    fewer words than ``width`` has one shingle of all of them, a text without words none. A block
    holds whole texts of about ``CHUNK`` bytes, or one longer text.
    """
    import numpy as np

    # Random values per byte: a polynomial in them tells words apart. Separators are 0.
    value = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
    value[65:91] = value[97:123]
    value[:48] = value[58:65] = value[91:97] = value[123:128] = 0
    start = 0
    while start < len(texts):
        parts, size, stop = [], 0, start
        while stop < len(texts) and (stop == start or size < CHUNK):
            parts.append(texts[stop].encode("utf-8", "replace") + b" ")
            size += len(parts[-1])
            stop += 1
        block = value[np.frombuffer(b"".join(parts), np.uint8)]
        inside = block > 0
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        begins, ends = edges[::2], edges[1::2]
        powers = np.cumprod(np.full(size, ODD, np.uint64))
        inverse = np.cumprod(np.full(size, ODD_INVERSE, np.uint64))
        sums = np.append(np.uint64(0), np.cumsum(block * powers, dtype=np.uint64))
        words = mix((sums[ends] - sums[begins]) * inverse[begins])
        text_ends = np.cumsum([len(part) for part in parts])
        owner = np.searchsorted(text_ends, begins, "right")
        counts = np.bincount(owner, minlength=len(parts))
        hashes = np.zeros(max(len(words) - width + 1, 0), np.uint64)
        for k in range(width):
            hashes = hashes * np.uint64(STEP) + words[k : k + len(hashes)]
        kept = owner[: len(hashes)] == owner[width - 1 :] if len(hashes) else np.zeros(0, bool)
        hashes, owners = hashes[kept], owner[: len(kept)][kept]
        if short := [i for i in np.flatnonzero((counts > 0) & (counts < width))]:
            firsts = np.searchsorted(owner, short)
            few = []
            for i, first in zip(short, firsts):
                h = np.uint64(counts[i])
                for word in words[first : first + counts[i]]:
                    h = np.uint64((int(h) * STEP + int(word)) & 0xFFFFFFFFFFFFFFFF)
                few.append(h)
            owners = np.append(owners, short)
            order = np.argsort(owners, kind="stable")
            hashes, owners = np.append(hashes, np.array(few, np.uint64))[order], owners[order]
        yield start, mix(hashes), owners, len(parts)
        start = stop


def shingle_sets(texts: list[str], width: int = WIDTH) -> list:
    """Sorted distinct shingle hashes of each text."""
    import numpy as np

    out = []
    for _, hashes, owner, n in shingle_blocks(texts, width):
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
        out += np.split(hashes[new], np.searchsorted(owner[new], np.arange(1, n)))
    return out


def permutations(count: int):
    """Multipliers and addends of universal hash functions from 64 to 32 bits (multiply, add, shift)."""
    import numpy as np

    rng = np.random.default_rng(8)
    return rng.integers(0, 1 << 63, (2, count), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(texts: list[str], count: int, width: int = WIDTH):
    """``count`` minima per text, one for each universal hash function; all ones for a text without words."""
    import numpy as np

    factors, addends = permutations(count)
    out = np.full((len(texts), count), 0xFFFFFFFF, np.uint32)
    for start, hashes, owner, n in shingle_blocks(texts, width):
        if not len(hashes):
            continue
        some, begins = np.unique(owner, return_index=True)
        # A stretch at a time stays in the cache for all functions.
        low = np.full((count, len(some)), 0xFFFFFFFFFFFFFFFF, np.uint64)
        for at in range(0, len(hashes), 16384):
            part = hashes[at : at + 16384]
            first, last = np.searchsorted(begins, [at, at + len(part) - 1], "right") - 1
            cuts = np.maximum(begins[first : last + 1] - at, 0)
            for k in range(count):
                minima = np.minimum.reduceat(part * factors[k] + addends[k], cuts)
                np.minimum(low[k, first : last + 1], minima, out=low[k, first : last + 1])
        out[start + some] = (low >> np.uint64(32)).T.astype(np.uint32)
    return out
