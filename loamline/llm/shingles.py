"""Word shingles of whole texts as sets of 64-bit hashes, with MinHash samples and odd sketches.

Words are runs without ASCII white space, A-Z in lower case. All documents of a batch are hashed
together in numpy: a word's hash is a difference of prefix sums of a polynomial.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLES = 128
BANDS = 32
SKETCH_BITS = 512
PARITY_BITS = 2_048

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, _U)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Sets:
    """Distinct shingles of several documents: document i has values[starts[i]:starts[i + 1]], sorted."""

    values: np.ndarray
    starts: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)


def shingle_sets(texts: list[str | None], words: int) -> Sets:
    """The sets of ``words``-word shingles. A shorter text is one shingle; one without words is empty."""
    raw = [(t or "").encode("utf-8", "replace").translate(_LOWER) for t in texts]
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    blank = _SPACE[data]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * _power(_BASE, len(data)), out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(data))[starts] + (ends - starts).astype(_U))
    bounds = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]) + 1
    first = np.searchsorted(starts, bounds)  # of each document's words
    counts = np.diff(first)
    n = max(0, len(h) - words + 1)
    s = np.zeros(n, _U)
    for k in range(words):
        s = mix(s * _U(0x9E3779B97F4A7C15) + h[k : k + n] + _U(k))
    parts = []
    for at, c in zip(first[:-1].tolist(), counts.tolist()):
        if c >= words:
            parts.append(np.sort(s[at : at + c - words + 1]))
        elif c:
            whole = np.zeros(1, _U)
            for k in range(c):
                whole = mix(whole * _U(0xD6E8FEB86659FD93) + h[at + k : at + k + 1] + _U(c))
            parts.append(whole)
        else:
            parts.append(np.zeros(0, _U))
    values = np.concatenate(parts) if parts else np.zeros(0, _U)
    edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[edges[:-1][np.diff(edges) > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return Sets(values[new], kept[edges])


def digests(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, whatever its order; equal for equal sets."""
    out = []
    for salt in (0x1234567F, 0x2545F4914F6CDD1D):
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(sets.values ^ _U(salt)), dtype=_U)])
        out.append(mix(sums[sets.starts[1:]] - sums[sets.starts[:-1]] + sets.sizes.astype(_U)).view(np.int64))
    return tuple(out)


def minhash(sets: Sets, samples: int = SAMPLES, seed: int = 1) -> np.ndarray:
    """``samples`` 32-bit minima for each set; sets without values have zeros."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 32, samples, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, samples, dtype=np.uint32)
    out = np.zeros((len(sets.starts) - 1, samples), np.uint32)
    filled = np.flatnonzero(sets.sizes > 0)
    if not len(filled):
        return out
    x = (mix(sets.values) >> _U(32)).astype(np.uint32)
    # Blocks of whole sets that stay in the cache.
    at = 0
    while at < len(filled):
        end = int(np.searchsorted(sets.starts[filled + 1], sets.starts[filled[at]] + (1 << 15), side="right"))
        end = max(end, at + 1)
        rows = filled[at:end]
        low, high = sets.starts[rows[0]], sets.starts[rows[-1] + 1]
        part, cuts = x[low:high], sets.starts[rows] - low
        buffer = np.empty_like(part)
        for k in range(samples):
            np.multiply(part, a[k], out=buffer)
            buffer ^= b[k]
            out[rows, k] = np.minimum.reduceat(buffer, cuts)
        at = end
    return out


def band_keys(samples: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of each row of samples; the band's number is part of it."""
    rows = samples.shape[1] // bands
    grouped = samples.astype(_U).reshape(len(samples), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=_U), (len(samples), bands))
    for k in range(rows):
        key = mix(key * _U(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmaps: every (place, sample) toggles one bit. A row of packed bytes for each set."""
    places = np.arange(samples.shape[1], dtype=_U)[None] << _U(32)
    at = (mix(samples.astype(_U) | places) % _U(bits)).astype(np.int64)
    rows = np.arange(len(samples))[:, None] * bits
    parity = np.bincount((rows + at).ravel(), minlength=len(samples) * bits) & 1
    return np.packbits(parity.astype(np.uint8).reshape(len(samples), bits), axis=1)


def parity_bitmaps(sets: Sets, bits: int = PARITY_BITS) -> np.ndarray:
    """The odd sketch of the whole set: every shingle toggles one bit. A row of packed bytes each.

    The XOR of two has at most as many set bits as the sets have shingles apart, so a pair with more
    than its similarity allows is ruled out for certain.
    """
    at = (mix(sets.values ^ _U(0x5DEECE66D)) % _U(bits)).astype(np.int64)
    n = len(sets.starts) - 1
    rows = np.repeat(np.arange(n) * bits, sets.sizes)
    parity = np.bincount(rows + at, minlength=n * bits) & 1
    return np.packbits(parity.astype(np.uint8).reshape(n, bits), axis=1)


def may_link(apart: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes a and b with at least ``apart`` elements not in common can be linked."""
    return apart * (100 + percent) <= (a + b) * (100 - percent)


def estimate(different: np.ndarray, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> np.ndarray:
    """The similarity that ``different`` set bits in the XOR of two odd sketches stand for."""
    rest = np.maximum(1 - 2 * np.asarray(different, float) / bits, 1e-9)
    return 1 + bits / (4 * samples) * np.log(rest)


def bits_allowed(similarity: float, samples: int = SAMPLES, bits: int = SKETCH_BITS, sigmas: float = 5.0) -> int:
    """The most differing bits at which a pair of at least this similarity may still be found.

    ``sigmas`` deviations of the number of differing samples, then half as many of the bits that so
    many toggles leave odd.
    """
    apart = samples * (1 - similarity) + sigmas * np.sqrt(samples * similarity * (1 - similarity))
    odd = bits / 2 * (1 - (1 - 2 / bits) ** (2 * apart))
    return int(odd + sigmas / 2 * np.sqrt(odd * (1 - odd / bits)))
