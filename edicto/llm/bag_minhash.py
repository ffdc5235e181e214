"""Weighted MinHash signatures by hierarchical Poisson processes (BagMinHash).

The weight of a word shingle is how often it occurs in its text.  Weights are
discretised at 0, 1, 2, 4, 8, ...: each interval between two such values has a
Poisson process of its own, seeded by the shingle and the interval, so two
texts share all points of the intervals (and parts of an interval) that both
weights cover.  Every point falls into one of REGISTERS registers, which keeps
the smallest.  Two texts agree in a register with a probability equal to their
weighted Jaccard similarity.  Points are made in rising order and only as long
as they can still lower a register.

The functions work on arrays of many texts at once, inside one task.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
BANDS = 36
ROWS = 6
REGISTERS = BANDS * ROWS

_G = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class WordHashes(dict):
    """64-bit hashes of words, kept while a batch is worked on."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multisets of word shingles: text number, shingle hash, count, sorted
    by the first two.  A text of fewer than five words is one shingle; a text
    without words has none."""
    hashes = WordHashes()
    rows = [np.fromiter(map(hashes.__getitem__, ws), dtype=np.uint64, count=len(ws))
            for ws in (t.encode("utf-8", "surrogatepass").split() for t in texts)]
    n_words = np.array([len(r) for r in rows], dtype=np.int64)
    total = int(n_words.sum())
    w = np.zeros(total + SHINGLE, dtype=np.uint64)
    if total:
        w[:total] = np.concatenate(rows)
    doc = np.repeat(np.arange(len(texts)), n_words)
    start = np.cumsum(n_words) - n_words
    left = n_words[doc] - (np.arange(total) - start[doc])  # words from here to the end
    h = np.zeros(total, dtype=np.uint64)
    for k in range(SHINGLE):
        h = mix(h * _G + np.where(left > k, w[k:k + total], np.uint64(k + 1)))
    keep = (left >= SHINGLE) | (left == n_words[doc])
    h, doc = h[keep], doc[keep]
    ends = np.cumsum(np.bincount(doc, minlength=len(texts)))
    for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):
        h[a:b].sort()
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def occurrences(texts: list[str]) -> list[np.ndarray]:
    """Each text's multiset of shingles as a set: the k-th occurrence of a
    shingle is an element of its own, so set overlap is multiset overlap."""
    doc, h, count = shingles(texts)
    rep = np.repeat(np.arange(len(h)), count)
    nth = np.arange(len(rep)) - np.repeat(np.cumsum(count) - count, count)
    out = mix(h[rep] + nth.astype(np.uint64) * _G).view(np.int64)
    return np.split(out, np.cumsum(np.bincount(doc[rep], minlength=len(texts)))[:-1])


def signatures(n: int, doc: np.ndarray, h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Registers of `n` texts (infinite where a text has no shingle)."""
    # one Poisson process for each shingle and weight interval
    docs, seeds, rates, parts = [doc], [h], [np.ones(len(h))], [np.ones(len(h))]
    low = 1
    while (more := count > low).any():
        docs.append(doc[more])
        seeds.append(mix(h[more] + np.uint64(low * int(_G) % 2**64)))
        rates.append(np.full(int(more.sum()), float(low)))
        parts.append((np.minimum(count[more], 2 * low) - low) / low)
        low *= 2
    doc, seed, rate, part = map(np.concatenate, (docs, seeds, rates, parts))
    weight = np.bincount(doc, weights=rate * part, minlength=n)
    sig = np.full(n * REGISTERS, np.inf)
    with np.errstate(divide="ignore"):
        bound = np.where(weight > 0, REGISTERS / weight * (np.log(REGISTERS) + 2), -1.0)
    z = mix(seed + _G)
    time, step = -np.log(unit(z)) / rate, np.ones(len(seed), dtype=np.uint64)
    while True:
        a = np.flatnonzero(time <= bound[doc])
        while len(a):
            s = seed[a] + step[a] * _G
            z = mix(s ^ _M1)
            hit = unit(mix(s ^ _M2)) < part[a]
            reg = doc[a] * REGISTERS + (z % np.uint64(REGISTERS)).astype(np.int64)
            np.minimum.at(sig, reg[hit], time[a][hit])
            step[a] += np.uint64(1)
            time[a] -= np.log(unit(mix(seed[a] + step[a] * _G))) / rate[a]
            a = a[time[a] <= bound[doc[a]]]
        missing = np.isinf(sig.reshape(n, REGISTERS)).any(axis=1) & (weight > 0)
        if not missing.any():
            return sig.reshape(n, REGISTERS)
        bound = np.where(missing, bound * 2, -1.0)


def bands(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per band (with the band's number in it), and one byte per register."""
    bits = sig.view(np.uint64).reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _G, (len(sig), BANDS))
    for r in range(ROWS):
        key = mix(key ^ bits[:, :, r])
    return key.view(np.int64), (mix(sig.view(np.uint64)) & np.uint64(255)).astype(np.uint8)
