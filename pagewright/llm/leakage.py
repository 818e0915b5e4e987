"""Evaluation items that leaked into a corpus.

Method: CGK embedding and bit sampling. A window of text walks at random over its characters: at each step one character
is written out, and a random bit that depends on the step and the character decides whether to move on. Texts at a small
edit distance end up at a small Hamming distance, and their differences come in bursts: what lies before an edit is
equal, and the two walks soon fall into step again behind it. So positions are sampled in blocks of successive steps; a
walk gives a key for each of its blocks, further walks give further ones. How many walks are needed is measured: windows
of the items are edited at random until the wanted share of them still has a key in common. What is found is verified
by its edit distance. Equal windows have equal keys, so passages without edits are found for certain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.words import _SPACED, by_chunk, mix, word_bytes
from pagewright.session import materialise

#: Steps of a block, and of a whole walk over a window of at least so many bytes.
BLOCK, STEPS = 32, 96
#: Windows that the number of walks is measured on, and walks at most.
MEASURED, MOST_WALKS = 2_000, 64
#: Keys up to which the index is sent around; beyond that documents' windows are filtered by a bit for each key and joined.
BROADCAST_KEYS, FILTER_BITS = 4_000_000, 26
#: First bytes of an item's window that also begin a window inside a word, and bits of the hash that they are told by: the same whether the index is sent around or joined, as what is found depends on it.
GLUED, GLUED_BITS = 6, 20
#: Pieces of a window that are compared before its edit distance is taken.
PIECES = 5
_PAD = STEPS + 8
_TABLE = bytes([0]) + _SPACED[1:]
_MUL = np.uint64(0x9E3779B97F4A7C15)


def streams(text: str) -> tuple[bytes, list[int]]:
    """The words of a text run together in lower case, and where each begins: line breaks, case, punctuation, spacing and words split across lines make no difference."""
    words = word_bytes(text)
    ends = np.cumsum([len(w) for w in words]).tolist()
    return b"".join(words), [0, *ends[:-1]] if words else []


def size_class(length: int) -> int:
    """Steps that a window's first block takes: all of a long one's, else the power of two that it holds."""
    return BLOCK if length >= BLOCK else 1 << (length.bit_length() - 1)


def blocks(steps: int) -> list[tuple[int, int]]:
    """(first step, end) of the blocks of a walk; the first is that which equal windows surely agree in."""
    if steps < BLOCK:
        return [(0, steps)] + ([(steps // 2, steps), (0, steps // 2)] if steps > 1 else [])
    return [(a, a + BLOCK) for a in range(0, STEPS - BLOCK + 1, BLOCK // 2)]


def walk_keys(chars: np.ndarray, at: np.ndarray, steps: int, walk: int, first_only: bool = False) -> np.ndarray:
    """A key for each block (row) of the windows that begin at `at` in a buffer of bytes, which goes on for STEPS bytes behind each."""
    parts = blocks(steps)[: 1 if first_only else None]
    bits = np.random.default_rng(1000 + walk).integers(0, 2, (STEPS, 256), dtype=np.int64)
    out = np.empty((len(parts), len(at)), np.uint64)
    for a in range(0, len(at), 8192):
        pos = at[a : a + 8192].astype(np.int64)
        keys = np.zeros((len(parts), len(pos)), np.uint64)
        for step in range(max(z for _, z in parts)):
            ch = chars.take(pos)
            wide = ch.astype(np.uint64)
            for k, (first, end) in enumerate(parts):
                if first <= step < end:
                    np.multiply(keys[k], _MUL, out=keys[k])
                    np.add(keys[k], wide, out=keys[k])
            pos += bits[step].take(ch)
        out[:, a : a + 8192] = keys
    for k in range(len(parts)):
        out[k] = mix(out[k] ^ np.uint64(((walk * 64 + k) * 64 + steps + 1) << 20))
    return out


def within(a: str, b: str, edits: int) -> int:
    """The least edit distance of a to a beginning of b, or edits + 1 if it is larger."""
    if b.startswith(a):
        return 0
    # The furthest place in a that each diagonal reaches with e edits, run on along equal characters.
    n, m = len(a), len(b)
    reach = {0: _run(a, b, 0, 0)}
    for e in range(1, edits + 1):
        now = {}
        for d in range(-e, e + 1):
            i = max(reach.get(d, -1) + 1, reach.get(d + 1, -2) + 1, reach.get(d - 1, -1))
            if 0 <= i <= n and 0 <= i + d <= m:
                now[d] = _run(a, b, i, i + d)
                if now[d] == n:
                    return e
            elif i > n:
                return e
        reach = now
    return edits + 1


def _run(a: str, b: str, i: int, j: int) -> int:
    """How far two texts are equal from two places on."""
    n = min(len(a) - i, len(b) - j)
    k = 0
    while k < n and a[i + k] == b[j + k]:
        k += 1
    return i + k


def _distance(window: bytes, text: bytes, edits: int) -> int:
    if text.startswith(window):
        return 0
    return within(window.decode("utf-8", "replace"), text[: len(window) + 4 * edits].split(b"\0", 1)[0].decode("utf-8", "ignore"), edits) if edits else 1


def _windows(items: DataFrame, words: int) -> DataFrame:
    """(item_id, window, more, steps): each run of so many words of an item, and the text that follows it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for item, text in zip(b["item_id"], b["text"]):
                s, begins = streams(text)
                begins = [*begins, len(s)]
                out += [(item, s[a:z], s[z : z + STEPS], size_class(z - a)) for a, z in zip(begins, begins[words:])]
            yield pd.DataFrame(out, columns=["item_id", "window", "more", "steps"])

    return items.mapInPandas(run, "item_id bigint, window binary, more binary, steps int").distinct()


def _laid(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows one behind the other, parted by zeros, and where each begins."""
    size = np.array([len(w) + _PAD for w in windows], np.int64)
    return np.frombuffer(b"".join(w + b"\0" * _PAD for w in windows), np.uint8), np.cumsum(size) - size


def _edited(window: bytes, more: bytes, edits: int, r: np.random.Generator) -> bytes:
    """A window with random edits, and what follows it."""
    s = list(window.decode("utf-8", "replace"))
    for _ in range(edits):
        at, kind = int(r.integers(len(s) + 1)), int(r.integers(3))
        s[at : at + (kind > 0)] = ["abcdefghijklmnopqrstuvwxyz0"[int(r.integers(27))]] if kind < 2 else []
        s = s or ["a"]
    return "".join(s).encode() + more


def walks_needed(windows: list[tuple[bytes, bytes]], steps: int, edits: int, recall: float) -> int:
    """Walks after which the wanted share of randomly edited windows has a key in common with the unedited ones; a tenth of what may be missed is kept back, as this is measured."""
    if edits == 0 or not windows:
        return 1
    r = np.random.default_rng(7)
    # Behind a passage a document goes on with something else.
    pairs = [(w + m, _edited(w, windows[int(r.integers(len(windows)))][0][::-1], edits, r)) for w, m in windows for _ in range(max(1, MEASURED // len(windows)))]
    sides = [_laid([p[k] for p in pairs]) for k in (0, 1)]
    found = np.zeros(len(pairs), bool)
    for walk in range(MOST_WALKS):
        a, b = (walk_keys(*side, steps, walk) for side in sides)
        found |= (a == b).any(axis=0)
        if found.mean() >= recall + (1 - recall) / 10:
            return walk + 1
    return MOST_WALKS


def leaks(docs: DataFrame, items: DataFrame, words: int = 10, edits: int = 2, recall: float = 0.95) -> DataFrame:
    """(doc_id, item_id, edits) of the documents that contain `words` successive words of an item; edits: the fewest characters that differ, `edits` at most.

    docs(doc_id, text), items(item_id, text); further columns don't matter. Texts are compared as their words run
    together in lower case, so line breaks, case, punctuation and spacing make no difference. Items of fewer words,
    null and empty texts give no row; equal passages of several items give a row for each; repeated rows count once;
    either table may be empty. A passage without edits is found for certain, another with probability `recall`; where
    a passage's first word is run together with the word before it, its first GLUED bytes must be right. Windows of a
    few characters can't all be found with edits: at most MOST_WALKS walks are made. The corpus is read once, each
    document whole by one task.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    wanted = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    windows = materialise(_windows(wanted, words), "leak-windows")
    held = {r["steps"]: (r["n"], r["longest"]) for r in windows.groupBy("steps").agg(F.count("*").alias("n"), F.max(F.length("window")).alias("longest")).collect()}  # as many rows as size classes
    plan = {}
    for steps in held:
        some = windows.where(F.col("steps") == steps).orderBy(F.xxhash64("window"), "window").limit(MEASURED).select("window", "more").collect()
        plan[steps] = walks_needed([(bytes(x["window"]), bytes(x["more"])) for x in some], steps, edits, recall)
    schema = "doc_id bigint, item_id bigint, edits int"
    if not plan:
        return spark.createDataFrame([], schema)
    total = sum(n * plan[s] * len(blocks(s)) for s, (n, _) in held.items())
    longest = max(x for _, x in held.values()) + 4 * edits
    index = _index(windows, plan, edits)
    bits = min(FILTER_BITS, max(16, math.ceil(math.log2(total)) + 5))
    if total <= BROADCAST_KEYS:
        rows = index.toPandas()
        shared = spark.sparkContext.broadcast((_Index(rows), _filter_of(rows["key"].to_numpy(np.int64), bits), _glued(rows["window"])))

        def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            idx, bitmap, glued = shared.value
            for ids, buffer, chars, at, owner in _laid_documents(batches, glued):
                yield idx.found(ids, buffer, at, owner, _hits(chars, at, plan, edits, bitmap), edits)

        return texts.mapInPandas(verified, schema).groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))

    index = materialise(index, "leak-index")
    bitmap = _collected_filter(index, "key", FILTER_BITS)
    begun = index.select(F.substring("window", 1, GLUED).alias("window")).distinct().mapInPandas(_begun, "key bigint").distinct()
    starts = spark.sparkContext.broadcast((bitmap, _collected_filter(begun, "key", GLUED_BITS)))

    def emitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap, glued = starts.value
        for ids, buffer, chars, at, owner in _laid_documents(batches, glued):
            hit = _hits(chars, at, plan, edits, bitmap)
            place = at[hit[0]]
            yield pd.DataFrame({"key": hit[1].view(np.int64), "doc_id": ids[owner[hit[0]]], "found": [buffer[p : p + longest].split(b"\0", 1)[0] for p in place]}).drop_duplicates()

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = np.array([_distance(w, t, edits) for w, t in zip(b["window"], b["found"])], np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "item_id": b["item_id"], "edits": d})[d <= edits]

    met = texts.mapInPandas(emitted, "key bigint, doc_id bigint, found binary").join(index, "key").select("doc_id", "item_id", "window", "found")
    return met.mapInPandas(judged, schema).groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))


def _index(windows: DataFrame, plan: dict[int, int], edits: int) -> DataFrame:
    """(key, item_id, window) of all keys of the items' windows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for steps, part in b.groupby("steps"):
                chars, at = _laid([w + m for w, m in zip(part["window"], part["more"])])
                for walk in range(plan[steps]):
                    for keys in walk_keys(chars, at, int(steps), walk, edits == 0):
                        yield pd.DataFrame({"key": keys.view(np.int64), "item_id": part["item_id"].to_numpy(), "window": part["window"].to_numpy()})

    return windows.mapInPandas(run, "key bigint, item_id bigint, window binary").distinct()


def _filter_of(keys: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(1 << bits, bool)
    out[(keys.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)] = True
    return out


def _collected_filter(rows: DataFrame, key: str, bits: int) -> np.ndarray:
    """As _filter_of, from keys that are only brought together as bits: 2**bits / 32 numbers at most."""
    place = F.shiftrightunsigned(key, 64 - bits)
    words = rows.select(F.shiftright(place, 5).alias("w"), F.expr(f"1L << CAST(shiftrightunsigned({key}, {64 - bits}) & 31 AS INT)").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    packed = np.zeros(1 << (bits - 5), np.uint32)
    packed[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).astype(np.uint32)
    return np.unpackbits(packed.view(np.uint8), bitorder="little").view(bool)


def _glued(windows: pd.Series) -> np.ndarray:
    """A bit for each beginning of a window."""
    out = np.zeros(1 << GLUED_BITS, bool)
    out[_places(windows)] = True
    return out


def _begun(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The places of :func:`_glued` as the first bits of keys."""
    for b in batches:
        yield pd.DataFrame({"key": (_places(b["window"]).astype(np.uint64) << np.uint64(64 - GLUED_BITS)).view(np.int64)})


def _places(windows: pd.Series) -> np.ndarray:
    long_ = [w[:GLUED] for w in windows.unique() if len(w) >= GLUED]
    return np.unique(_beginnings(np.frombuffer(b"".join(long_), np.uint8))[::GLUED])


def _beginnings(chars: np.ndarray) -> np.ndarray:
    """A hash of the GLUED bytes from each place on."""
    n = max(0, len(chars) - GLUED + 1)
    h = np.zeros(n, np.uint32)
    for k in range(GLUED):
        h *= np.uint32(0x01000193)
        h += chars[k : k + n]
    h *= np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - GLUED_BITS)


def _laid_documents(batches: Iterator[pd.DataFrame], glued: np.ndarray) -> Iterator[tuple]:
    """(ids, buffer, its bytes, where windows begin, the number of the document of each), a chunk of documents at a time."""
    gap = b" " + b"\0" * _PAD + b" "
    for b in batches:
        ids = b["doc_id"].to_numpy()
        for first, parts in by_chunk(t.replace("\0", " ") for t in b["text"]):
            raw = np.frombuffer((gap + gap.join(parts) + gap).translate(_TABLE), np.uint8)
            inside = raw != 32
            chars = raw[inside]
            edge = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
            at = (np.cumsum(inside) - 1)[edge]
            at = at[chars[at] != 0]
            more = np.flatnonzero(glued.take(_beginnings(chars)))
            at = np.union1d(at, more[chars[more] != 0]) if len(more) else at
            if not len(at):
                continue
            zero = np.cumsum(chars == 0)
            yield ids[first : first + len(parts)], chars.tobytes(), chars, at, zero[at] // _PAD - 1


def _hits(chars: np.ndarray, at: np.ndarray, plan: dict[int, int], edits: int, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the window, key) of the documents' windows whose key may be one of the items'."""
    shift = np.uint64(64 - int(len(bitmap)).bit_length() + 1)
    which, keys = [], []
    for steps, walks in plan.items():
        for walk in range(walks):
            for k in walk_keys(chars, at, steps, walk, edits == 0):
                hit = np.flatnonzero(bitmap.take((k >> shift).astype(np.int64)))
                which.append(hit)
                keys.append(k[hit])
    return np.concatenate(which), np.concatenate(keys)


class _Index:
    """The items' windows by key."""

    def __init__(self, rows: pd.DataFrame):
        code, pairs = pd.factorize(pd.MultiIndex.from_arrays([rows["item_id"], rows["window"]]))
        self.pairs = list(pairs)
        order = np.argsort(rows["key"].to_numpy(np.int64).view(np.uint64), kind="stable")
        self.keys, self.pair = rows["key"].to_numpy(np.int64).view(np.uint64)[order], code[order]
        # Pieces of eight bytes, apart from each other, of each window.
        self.pieces = np.array([min(PIECES, len(w) // 8) for _, w in self.pairs], np.int64)
        self.wide = np.array([max(w) >= 0x80 for _, w in self.pairs], bool)
        self.offset, self.piece = np.zeros((len(self.pairs), PIECES), np.int64), np.zeros((len(self.pairs), PIECES), np.uint64)
        for i, (_, w) in enumerate(self.pairs):
            for j in range(self.pieces[i]):
                at = j * (len(w) // self.pieces[i])
                self.offset[i, j], self.piece[i, j] = at, int.from_bytes(w[at : at + 8], "little")

    def possible(self, buffer: bytes, place: np.ndarray, pair: np.ndarray, edits: int) -> np.ndarray:
        """Whether enough pieces of a window stand about where they should: an edit spoils one, or two where characters are wide, and shifts what follows by as many bytes as a character has, those of the text having up to four."""
        padded = b"\0" * 64 + buffer + b"\0" * 64
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        back, far = edits * (4 if self.wide[pair].any() else 1), edits * 4
        alive = np.arange(len(place))
        missed = np.zeros(len(place), np.int64)
        for j in range(PIECES):
            k = pair[alive]
            at, want = place[alive] + self.offset[k, j] + 64, self.piece[k, j]
            hit = j >= self.pieces[k]
            for shift in range(-back, far + 1):
                hit |= eight.take(at + shift, mode="clip") == want
            missed[alive] += ~hit
            alive = alive[missed[alive] <= edits * (1 + self.wide[k])]
        out = np.zeros(len(place), bool)
        out[alive] = True
        return out

    def found(self, ids: np.ndarray, buffer: bytes, at: np.ndarray, owner: np.ndarray, hits: tuple[np.ndarray, np.ndarray], edits: int) -> pd.DataFrame:
        """The verified rows of a chunk of documents; a pair isn't looked at further once it is found without edits."""
        which, keys = hits
        lo, hi = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        many = hi - lo
        which = np.repeat(which, many)
        entry = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(len(which))
        rows = np.unique(which * max(1, len(self.pairs)) + self.pair[entry])  # a window meets another by several keys
        which, pair = rows // max(1, len(self.pairs)), rows % max(1, len(self.pairs))
        ok = np.concatenate([self.possible(buffer, at[which[a : a + 100_000]], pair[a : a + 100_000], edits) for a in range(0, len(which), 100_000)] or [np.zeros(0, bool)])
        which, pair = which[ok], pair[ok]
        best: dict[tuple[int, int], int] = {}
        for doc, place, k in zip(owner[which].tolist(), at[which].tolist(), pair.tolist()):
            item, w = self.pairs[k]
            now = best.get((doc, item), edits + 1)
            if now:
                d = _distance(w, buffer[place : place + len(w) + 4 * edits], edits)
                if d < now:
                    best[doc, item] = d
        return pd.DataFrame([(ids[d], i, n) for (d, i), n in best.items()], columns=["doc_id", "item_id", "edits"])
