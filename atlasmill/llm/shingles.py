"""Word and shingle hashes of whole texts, in NumPy over one byte buffer for many texts at a time.

A word's hash is a polynomial over its bytes modulo 2**64, taken from prefix sums and then mixed; a shingle's hash
combines those of its words. Equal words always have equal hashes; different ones share one with probability near 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
CHUNK = 1 << 18
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Bytes that aren't part of a term: all of ASCII but letters and digits. Bytes of non-ASCII characters are.
NOT_TERM = np.ones(256, bool)
NOT_TERM[128:] = False
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    NOT_TERM[ord(_a) : ord(_b) + 1] = False


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_WEIGHTS = mix(np.arange(1, 65, dtype=U64) * U64(_P)) | U64(1)


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 4096)
        have = np.full(size, base, U64)
        have[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(have)
        if size <= 4 * CHUNK:  # tables for one very long text aren't kept
            _powers[base] = have
    return have[:n]


def chunks(texts: list[str | None], size: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of about size bytes of lower-cased (A-Z only) UTF-8; null counts as empty. With each, the first text's place."""
    run: list[bytes] = []
    first = held = 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass").lower() if t else b""
        if run and held + len(b) > size:
            yield first, run
            run, first, held = [], i, 0
        run.append(b)
        held += len(b) + 1
    if run:
        yield first, run


def words(run: list[bytes], gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a run of texts, and for each text (and one more) the place of its first word."""
    buf = np.frombuffer(b"\n".join(run) + b"\n", np.uint8)
    solid = np.empty(len(buf) + 1, np.int8)
    solid[0] = 0
    solid[1:] = ~gap[buf]
    edge = np.diff(solid)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.empty(len(buf) + 1, U64)
    total[0] = 0
    np.cumsum((buf.astype(U64) + U64(1)) * _power(_P, len(buf)), out=total[1:])
    h = (total[end] - total[start]) * _power(_P_INV, len(buf))[start]
    h = mix(h ^ ((end - start).astype(U64) << U64(48)))
    at = np.concatenate(([0], np.cumsum(np.fromiter((len(b) + 1 for b in run), np.int64, len(run)))))
    return h, np.searchsorted(start, at)


def combine(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words."""
    if len(h) < k:
        return np.empty(0, U64)
    out = np.zeros(len(h) - k + 1, U64)
    for j in range(k):
        out += h[j : len(h) - k + 1 + j] * _WEIGHTS[j]
    return mix(out)


def shingle_lists(texts: list[str | None], k: int = 5) -> Iterator[np.ndarray]:
    """For each text the hashes of its k-word shingles in order; under k words, one for the whole sequence; none without words."""
    for _, run in chunks(texts):
        h, at = words(run)
        all_k = combine(h, k)
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= k:
                yield all_k[a : b - k + 1]
            elif b > a:
                yield mix((h[a:b] * _WEIGHTS[: b - a]).sum(keepdims=True) + U64((int(b - a) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF))
            else:
                yield np.empty(0, U64)


def shingle_sets(texts: list[str | None], k: int = 5) -> Iterator[np.ndarray]:
    for x in shingle_lists(texts, k):
        yield np.unique(x)


def term_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its terms (runs of letters, digits and non-ASCII characters)."""
    for _, run in chunks(texts):
        h, at = words(run, NOT_TERM)
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield np.unique(h[a:b])
