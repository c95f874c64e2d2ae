"""Words and word shingles as 64-bit hashes, many texts at a time (numpy).

A word is a maximal run of ``0-9 a-z _`` and characters outside ASCII in the
lower-cased text.  Texts are laid end to end as bytes, all words of a chunk are
hashed at once, and shingles are mixed from the hashes of neighbouring words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE = 5
CHUNK = 1 << 20  # bytes hashed at once; a longer text is a chunk of its own

_U = np.uint64
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _U(0x9E3779B97F4A7C15 | 1)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), 95, *range(128, 256)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """``(hash, text number, first byte, end byte)`` of every word; byte places
    count from the start of the lower-cased text, whose bytes come last."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
    inside = _IN_WORD[buf]
    turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first, end = turn[0::2], turn[1::2]
    begins = 1 + np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])[:-1] if raw else np.zeros(0, np.int64)
    if not len(first):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z, raw
    length = end - first
    at = np.repeat(first, length)
    place = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    power = np.cumprod(np.concatenate([[_U(1)], np.full(int(length.max()), _STEP, np.uint64)]), dtype=np.uint64)
    h = np.add.reduceat(_BYTE[buf[at + place]] * power[place], np.cumsum(length) - length)
    of = np.searchsorted(begins, first, "right") - 1
    return mix(h + length.astype(np.uint64)), of, first - begins[of], end - begins[of], raw


def grams(h: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within a text, and the number of the first word."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(of[: len(of) - n + 1] == of[n - 1:])
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out += h[at + k] * _PLACE[k]
    return mix(out), at


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``CHUNK`` characters: first number and texts."""
    start, size, run = 0, 0, []
    for i, t in enumerate(texts):
        t = t or ""
        if run and size + len(t) > CHUNK:
            yield start, run
            start, size, run = i, 0, []
        run.append(t)
        size += len(t)
    if run:
        yield start, run


def shingle_sets(texts: list[str | None], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingles of every text.  A text of fewer than ``n`` words
    has one shingle, all its words; a text without words has none."""
    out: list[np.ndarray] = []
    for _, run in chunks(texts):
        h, of, _, _, _ = words(run)
        g, at = grams(h, of, n)
        gof = of[at]
        cut = np.searchsorted(gof, np.arange(len(run) + 1))
        wcut = np.searchsorted(of, np.arange(len(run) + 1))
        for i in range(len(run)):
            part = g[cut[i]:cut[i + 1]]
            if len(part):
                part = np.sort(part)
                keep = np.ones(len(part), bool)
                keep[1:] = part[1:] != part[:-1]
                out.append(part[keep])
                continue
            w = h[wcut[i]:wcut[i + 1]]
            out.append(mix(np.asarray([sum(int(x) * int(p) for x, p in zip(w, _PLACE[8:], strict=False)) + len(w) & 0xFFFFFFFFFFFFFFFF], np.uint64)) if len(w) else np.zeros(0, np.uint64))
    return out
