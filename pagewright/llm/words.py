"""Words and runs of words of a batch of texts as numpy arrays."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard

#: Maximal runs of letters and digits, and of letters alone.
WORD = re.compile(r"[^\W_]+")
LETTERS = re.compile(r"[^\W\d_]+")

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= _M1
        x ^= x >> np.uint64(27)
        x *= _M2
        x ^= x >> np.uint64(31)
    return x


def split(texts: Iterable[str], pattern: re.Pattern) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number of each word, code of each word, distinct words by code) of the lower-case texts."""
    found: list[str] = []
    counts = []
    for t in texts:
        w = pattern.findall(t.lower())
        counts.append(len(w))
        found += w
    codes, distinct = pd.factorize(np.array(found, dtype=object)) if found else (np.zeros(0, np.int64), np.zeros(0, object))
    return np.repeat(np.arange(len(counts)), counts), codes, distinct


#: Every ASCII character that is no letter or digit becomes a space; other bytes belong to words.
_SPACED = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))
_OTHER = re.compile(r"[^\w\x00-\x7f]+")


def word_bytes(text: str) -> list[bytes]:
    """The words of a text in lower case, as WORD finds them, in UTF-8; several times faster than the pattern."""
    text = text.lower()
    if not text.isascii():
        text = _OTHER.sub(" ", text)
    return text.encode("utf-8", "surrogatepass").translate(_SPACED).split()


#: Bytes of text that are hashed at a time, so that the arrays stay in the processor's caches; texts at a time, whose numbers fit beside a hash.
_CHUNK, _OWNERS = 1 << 18, 60_000
#: The bytes of a number that belong to a word of 0 to 8 bytes that begins there.
_OWN = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def by_chunk(texts: Iterable[str]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in lower case and UTF-8, a chunk of them at a time, with the number of the first."""
    first, held, size = 0, [], 0
    for t in texts:
        t = t.lower()
        if not t.isascii():
            t = _OTHER.sub(" ", t)
        held.append(t.encode("utf-8", "surrogatepass"))
        size += len(held[-1]) + 1
        if size >= _CHUNK or len(held) >= _OWNERS:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held


def _hash_chunk(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the part, 64-bit hash) of each word, eight bytes at a time, without a Python object for any word."""
    a = np.frombuffer((b" " + b" ".join(parts) + b" " * 9).translate(_SPACED), np.uint8)
    inside = a != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, size = edge[::2], edge[1::2] - edge[::2]
    eight = np.ndarray((len(a) - 7,), "<u8", a, 0, (1,))  # the eight bytes from each place on
    h = eight[start] & _OWN[np.minimum(size, 8)]
    longer, k = np.flatnonzero(size > 8), 8
    while len(longer):
        with np.errstate(over="ignore"):
            h[longer] = mix(h[longer]) + (eight[start[longer] + k] & _OWN[np.minimum(size[longer] - k, 8)])
        k += 8
        longer = longer[size[longer] > k]
    ends = 1 + np.cumsum(np.array([len(p) + 1 for p in parts], np.int64))  # where each part's following blank ends
    return np.repeat(np.arange(len(parts)), np.diff(np.searchsorted(start, ends), prepend=0)), mix(h)


def hashed(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of each word."""
    out = [(first + own, h) for first, parts in by_chunk(texts) for own, h in [_hash_chunk(parts)]]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


#: Bits of the hash of a run of words.
RUN_BITS = 48


def runs_of(h: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each `size` successive words, whatever text they belong to."""
    last = len(h) - size + 1
    run = h[:last].copy()
    with np.errstate(over="ignore"):
        for k in range(1, size):
            run = ((run << np.uint64(21)) | (run >> np.uint64(43))) * _M1 + h[k : k + last]
    return mix(run)


def shingle_sets(texts: Iterable[str], size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash of RUN_BITS bits) of the distinct runs of `size` words, sorted; texts of fewer than `least` words have none."""
    out = []
    for base, parts in by_chunk(texts):
        owner, h = _hash_chunk(parts)
        last = len(h) - size + 1
        if last <= 0:
            continue
        n = np.bincount(owner, minlength=len(parts))
        ok = (owner[:last] == owner[size - 1 :]) & (n[owner[:last]] >= max(least, size))
        # The text's number stands before the hash, so that one sort of numbers does.
        both = (owner[:last][ok].astype(np.uint64) << np.uint64(RUN_BITS)) | (runs_of(h, size)[ok] >> np.uint64(64 - RUN_BITS))
        both.sort()
        both = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
        out.append((base + (both >> np.uint64(RUN_BITS)).astype(np.int64), both & np.uint64((1 << RUN_BITS) - 1)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


_ZIP = zstandard.ZstdCompressor(level=1)
_UNZIP = zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; columns of small numbers shrink well, hashes don't."""
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    return _ZIP.compress(len(head).to_bytes(4, "little") + head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpack(blob: bytes) -> list[np.ndarray]:
    """What :func:`pack` packed."""
    raw = _UNZIP.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    at, out = 4 + n, []
    for part in raw[4:at].decode().split(";"):
        kind, count = part.split(",")
        a = np.frombuffer(raw, dtype=kind, count=int(count), offset=at)
        out.append(a)
        at += a.nbytes
    return out


def pack_gaps(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that rise from each start on, as the low bytes and the rest of their gaps; apart they compress far better."""
    gaps = np.diff(values, prepend=0)
    gaps[starts] = values[starts]
    high = gaps >> 8
    kind = np.uint8 if not len(high) or high.max() < 256 else np.uint16 if high.max() < 65536 else np.uint64
    return (gaps & 255).astype(np.uint8), high.astype(kind)


def unpack_gaps(low: np.ndarray, high: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers that :func:`pack_gaps` packed, given how many follow each start."""
    sums = np.cumsum(low.astype(np.int64) + (high.astype(np.int64) << 8))
    begin = np.cumsum(counts.astype(np.int64)) - counts
    return sums - np.repeat(np.where(begin > 0, sums[begin - 1], 0), counts) if len(sums) else sums
