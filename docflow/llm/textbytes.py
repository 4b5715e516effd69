"""Vectorised hashing of spans of bytes, for use inside tasks.

Span hashes are polynomials modulo 2^64 with an odd multiplier, taken from prefix sums and brought
to position 0 by the multiplier's inverse, then mixed. Equal spans have equal hashes wherever they
lie. Memory: about 50 bytes for each byte of the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd

U = np.uint64
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
BATCH_BYTES = 1_000_000

_powers = (np.ones(1, dtype=U), np.ones(1, dtype=U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = pow(MULTIPLIER, -1, 1 << 64)
        made = []
        for base in (MULTIPLIER, inverse):
            steps = np.full(size, base, dtype=U)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=U))
        _powers = tuple(made)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    up, _ = powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, dtype=U)
    np.cumsum((raw.astype(U) + U(1)) * up[: len(raw)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def plain_words(text: str | None) -> bytes:
    """Lower-cased words ``[^\\x20\\x09-\\x0D]+`` joined by single blanks, as UTF-8."""
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").split())


def digest64(raw: bytes) -> int:
    """A signed 64-bit digest."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def batches(sizes: list[int], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of items that hold about ``limit`` bytes; a larger item is a range of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def shingles(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every shingle of ``width`` words, in order; a text with fewer words,
    but not none, is one shingle. Texts are as ``plain_words`` gives them."""
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))
    full = ends > starts
    starts, ends = starts[full], ends[full]
    closing = np.cumsum([len(t) + 1 for t in texts]) - 1
    owner = np.searchsorted(closing, starts, side="left")
    words = span_hashes(prefix_sums(raw), starts, ends)
    weights = mix(np.arange(1, width + 1, dtype=U)) | U(1)
    n = len(words)
    if n >= width:
        total = np.zeros(n - width + 1, dtype=U)
        for k in range(width):
            total += words[k : n - width + 1 + k] * weights[k]
        inside = owner[: n - width + 1] == owner[width - 1 :]
        found, hashes = owner[: n - width + 1][inside], mix(total[inside])
    else:
        found, hashes = owner[:0], words[:0]
    counts = np.bincount(owner, minlength=len(texts))
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        firsts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        extra = np.array(
            [
                mix(np.array([(words[firsts[d] : firsts[d] + counts[d]] * weights[: counts[d]]).sum(dtype=U)], dtype=U) + U(counts[d]))[0]
                for d in short
            ],
            dtype=U,
        )
        found, hashes = np.concatenate((found, short)), np.concatenate((hashes, extra))
    return found, hashes


def distinct(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted by text, with their counts."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))


def band_codes(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit code for each band of ``rows`` columns."""
    n, m = signature.shape
    weights = mix(np.arange(101, 101 + rows, dtype=U)) | U(1)
    cut = signature[:, : m // rows * rows].reshape(n, m // rows, rows)
    return mix((cut * weights).sum(axis=2, dtype=U)).view(np.int64)


SKETCH_WORDS = 16


def sketches(owner: np.ndarray, hashes: np.ndarray, n: int, words: int = SKETCH_WORDS) -> np.ndarray:
    """For each of ``n`` sets, one bit of each of 64 * ``words`` MinHash values. Two sets agree in a
    bit with probability (1 + J) / 2. ``owner`` is sorted; sets without values keep zeros."""
    out = np.zeros((n, words), dtype=U)
    present, firsts = np.unique(owner, return_index=True)
    if not len(present):
        return out.view(np.int64)
    factors = mix(np.arange(5001, 5001 + 64 * words, dtype=U)) | U(1)
    for k, f in enumerate(factors):
        least = np.minimum.reduceat(hashes * f, firsts)
        bit = (least * U(0xBF58476D1CE4E5B9)) >> U(63)
        out[present, k // 64] |= bit << U(k % 64)
    return out.view(np.int64)


def parities(owner: np.ndarray, hashes: np.ndarray, n: int, words: int) -> np.ndarray:
    """For each of ``n`` sets one bit for each of 64 * ``words`` bins of values: whether it holds an odd
    number of them. Two sets differ in at least as many values as they do in bits."""
    out = np.zeros(n * words, dtype=U)
    place = mix(hashes ^ U(0x2545F4914F6CDD1D)) % U(64 * words)
    np.bitwise_xor.at(out, owner.astype(np.int64) * words + (place >> U(6)).astype(np.int64), U(1) << (place & U(63)))
    return out.reshape(n, words).view(np.int64)


def most_different_bits(threshold: float, deviations: float = 3.3) -> int:
    """Differing bits that sets at the threshold exceed only beyond so many standard deviations."""
    bits = 64 * SKETCH_WORDS
    p = (1 - threshold) / 2
    return int(bits * p + deviations * (bits * p * (1 - p)) ** 0.5)


def shingle_sets(ids: pd.Series, texts: list[bytes], width: int) -> Iterator[tuple[pd.DataFrame, tuple[int, int]]]:
    """``id, grams, sketch`` of each text, batch by batch, with the range of texts in the batch."""
    for a, b in batches([len(t) for t in texts]):
        owner, hashes, _ = distinct(*shingles(texts[a:b], width))
        cuts = np.searchsorted(owner, np.arange(b - a + 1))
        grams = hashes.view(np.int64)
        yield (
            pd.DataFrame(
                {
                    "id": ids.iloc[a:b].reset_index(drop=True),
                    "grams": [grams[cuts[i] : cuts[i + 1]] for i in range(b - a)],
                    "sketch": list(sketches(owner, hashes, b - a)),
                }
            ),
            (a, b),
        )
