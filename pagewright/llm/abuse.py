"""Scores for abusive, hateful or sexual language.

Method: multiple-instance learning. A document is a bag of passages, of which only the document's label is known. Each
passage has a probability from a linear model over its words; the document's is their noisy-or, 1 - prod(1 - p). The
model is trained on that, so that it finds out which passages made a document offensive. It then scores every passage
of every document. Words are first rid of disguises: spaced, repeated, swapped and masked letters.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import materialise

#: Labelled documents the model is fitted on at most (the rest, by a hash of their ids, is left out), weights, passage length in words.
MOST_LABELLED, BITS, LONGEST = 20_000, 18, 14
#: Bytes of labelled texts that are brought to the driver at most.
MOST_BYTES = 100_000_000
LEAST_POSITIVE = 2
#: Scores below and above which a label that says otherwise is left out, and the share of either sort that may be.
DOUBT, MOST_WRONG = (0.05, 0.6), 0.2
#: Score from which a document is taken for offending.
OFFENDING = 0.3
#: Support by other documents from which an offensive label isn't doubted.
SUPPORTED = 5.0
KINDS = ("abusive", "hateful", "sexual")

_BREAK = re.compile("[-­¬]\\s*\n\\s*")
_END = re.compile(r"[.!?…]+(?=\s|$)|\n\s*\n|=== PAGE \d+ ===|\s[-•◦▪]\s|;|\t|\|")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_][-.*_ ]){3,}[^\W_](?![^\W_])")
_REPEAT = re.compile(r"([^\W\d_])\1{2,}")
_TOKEN = re.compile(r"[^\W_](?:[^\W_]|[@$*!](?=[^\W_@$*!]|[@$*!]+[^\W_]))*|[@$](?:[^\W_]|[@$*!])*[^\W_]")
# Characters that stand for letters in disguised words.
_SWAP = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})


def plain_words(text: str) -> list[str]:
    """Words without accents, case and swapped or repeated letters; a word with masked letters becomes its ends and '*', numbers '0'."""
    return [w for t in text.lower().split() for w in _plain(t)]


@functools.lru_cache(maxsize=300_000)
def _plain(token: str) -> tuple[str, ...]:
    """The plain words of what stands between blanks; most comes again, so it is kept."""
    out = []
    for w in _TOKEN.findall(token):
        if w.isdigit():
            out.append("0")
            continue
        if not w.isascii():
            w = "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c)).replace("ß", "ss")
        if not w.isalpha():
            if "*" in w:
                out.append(f"{w[0]}*{w[-1]}")
                continue
            digits = sum(c.isdigit() for c in w)
            if 2 * digits >= len(w):
                out.append("code")
                continue
            w = w.translate(_SWAP)
        out.append(_REPEAT.sub(r"\1", w))
    return tuple(out)


def passages(text: str) -> list[str]:
    """Sentences, list items and the like, with words joined whose letters are spaced or that a line break splits; longer ones as overlapping windows of LONGEST words."""
    out = []
    text = _SPACED.sub(lambda m: re.sub(r"[-.*_ ]", "", m[0]), _BREAK.sub("", text))
    for part in _END.split(text):
        tokens = part.split()
        if len(tokens) <= LONGEST:
            if tokens:
                out.append(" ".join(tokens))
        else:
            step = LONGEST // 2
            out += [" ".join(tokens[i : i + LONGEST]) for i in range(0, len(tokens) - step, step)]
    return out


def features(passage: str) -> list[int]:
    """Places of a passage's words, pairs of words, pairs with one word between, and word beginnings."""
    w = plain_words(passage)
    out = {k for x in w for k in _word(x)}
    out.update(map(_pair, w, w[1:]))
    out.update(map(_apart, w, w[2:]))
    return sorted(out)


def _place(name: str) -> int:
    return xxhash.xxh32_intdigest(name) & ((1 << BITS) - 1)


@functools.lru_cache(maxsize=300_000)
def _word(x: str) -> tuple[int, ...]:
    return (_place(x), *([_place(f"{x[:5]}-")] if len(x) > 5 else []), *([_place("*")] if "*" in x else []))


@functools.lru_cache(maxsize=500_000)
def _pair(a: str, b: str) -> int:
    return _place(f"{a} {b}")


@functools.lru_cache(maxsize=500_000)
def _apart(a: str, b: str) -> int:
    return _place(f"{a} _ {b}")


class Bags:
    """The features of the passages of labelled documents."""

    def __init__(self, texts: list[str]):
        places, sizes, bag = [], [], []
        for i, t in enumerate(texts):
            for p in passages(t) or [""]:
                f = features(p)
                places += f
                sizes.append(len(f))
                bag.append(i)
        self.at = np.array(places, np.int32)
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.bag = np.array(bag, np.int64)
        self.rows, self.bags = len(sizes), len(texts)


def train(bags: Bags, y: np.ndarray, weight: np.ndarray | None = None, rounds: int = 80, rate: float = 0.2, ridge: float = 2e-5) -> np.ndarray:
    """Weights, the last being the bias, by Adam on the cross-entropy of the noisy-or; documents of weight 0 don't count."""
    n = 1 << BITS
    share = (np.ones(bags.bags) if weight is None else weight) / max(1.0, bags.bags if weight is None else weight.sum())
    used, at = np.unique(bags.at, return_inverse=True)
    # What is in fewer than LEAST_POSITIVE offensive documents can only speak for harmlessness.
    pair = np.unique(at.astype(np.int64) * bags.bags + bags.bag[bags.row])
    offensive = (y > 0.5) & (share > 0)
    rare = np.bincount(pair // bags.bags, weights=offensive[pair % bags.bags], minlength=len(used)) < min(LEAST_POSITIVE, offensive.sum())
    w = np.zeros(len(used))
    bias = -5.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(bags.row, weights=w[at], minlength=bags.rows) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        logs = np.bincount(bags.bag, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=bags.bags)
        none = np.exp(logs)
        doc = np.clip(1 - none, 1e-7, 1 - 1e-7)
        # d loss / d z of a passage: p, less p / doc where the document is positive.
        g = p * (1 - y[bags.bag] / doc[bags.bag]) * share[bags.bag]
        gw, gb = np.bincount(at, weights=g[bags.row], minlength=len(w)) + ridge * w, g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.99**t
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-6)
        w[rare & (w > 0)] = 0
        bias -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-6)
    out = np.zeros(n + 1)
    out[used], out[n] = w, bias
    return out


def support(bags: Bags, y: np.ndarray) -> np.ndarray:
    """How much other offensive documents speak for each document: the best sum over a passage of its features' log odds above 2, its own label not counted."""
    used, at = np.unique(bags.at, return_inverse=True)
    pair = np.unique(at.astype(np.int64) * bags.bags + bags.bag[bags.row])
    f, d = pair // bags.bags, pair % bags.bags
    bad = np.bincount(f, weights=y[d] > 0.5, minlength=len(used))
    good = np.bincount(f, weights=y[d] <= 0.5, minlength=len(used))
    n = max(1.0, (y > 0.5).sum()), max(1.0, (y <= 0.5).sum())
    own = y[bags.bag[bags.row]] > 0.5
    odds = np.log((bad[at] - own + 0.25) / n[0]) - np.log((good[at] + 0.25) / n[1])
    passage = np.bincount(bags.row, weights=np.maximum(odds - 2, 0) * (bad[at] - own >= 2), minlength=bags.rows)
    out = np.zeros(bags.bags)
    np.maximum.at(out, bags.bag, passage)
    return out


def train_robust(bags: Bags, y: np.ndarray, folds: int = 4) -> np.ndarray:
    """Train on all folds but one, leave out the labels in that one which the model contradicts outright and no other documents support, train on the rest.

    A wrong label would otherwise be learned by heart from the words that happen to be in its document.
    """
    fold = np.random.default_rng(0).permutation(bags.bags) % folds
    other = np.zeros(bags.bags)
    for k in range(folds):
        w = train(bags, y, (fold != k).astype(float), rounds=50)
        z = np.bincount(bags.row, weights=w[bags.at], minlength=bags.rows) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        doc = -np.expm1(np.bincount(bags.bag, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=bags.bags))
        other[fold == k] = doc[fold == k]
    other = np.where((y > 0.5) & (support(bags, y) >= SUPPORTED), 1.0, other)
    wrong = np.zeros(bags.bags, bool)
    for own, doubt, bound in ((y > 0.5, other, DOUBT[0]), (y <= 0.5, 1 - other, 1 - DOUBT[1])):
        worst = np.sort(doubt[own])[: int(MOST_WRONG * own.sum())]
        if len(worst):
            wrong |= own & (doubt < bound) & (doubt <= worst[-1])
    kept = y[~wrong]
    return train(bags, y, (~wrong).astype(float)) if kept.size and kept.min() < 0.5 < kept.max() else train(bags, y)


def scores(texts: list[str], models: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """(noisy-or of each text for each model, the worst passage by the first model)."""
    bag, place, size, parts = [], [], [], []
    for i, t in enumerate(texts):
        for p in passages(t):
            f = features(p)
            place += f
            size.append(len(f))
            bag.append(i)
            parts.append(p)
    out, worst = np.zeros((len(texts), len(models))), [""] * len(texts)
    if parts:
        row, bag = np.repeat(np.arange(len(parts)), size), np.array(bag)
        for k, w in enumerate(models):
            z = np.bincount(row, weights=w[np.array(place, np.int64)], minlength=len(parts)) + w[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            out[:, k] = -np.expm1(np.bincount(bag, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(texts)))
            if k == 0:
                for j in np.argsort(p, kind="stable"):
                    worst[bag[j]] = parts[j]
    return out, worst


def fit(docs: DataFrame, labels: DataFrame, kinds: bool = False) -> np.ndarray:
    """The model for any of the kinds, and with `kinds` one for each, from at most MOST_LABELLED labelled documents of MOST_BYTES together.

    A document's target is the share of its labels that are of the kind; repeated labels count once. Without labels of
    both sorts the model finds nothing.
    """
    target = [F.avg((F.col("label") == k).cast("double")).alias(k) for k in KINDS]
    marks = labels.select("doc_id", "label", "reviewer").distinct().where("doc_id IS NOT NULL AND label IS NOT NULL")
    marks = marks.groupBy("doc_id").agg(F.avg((F.col("label") != "none").cast("double")).alias("any"), *target)
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED)
    own = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(marks), "doc_id").dropDuplicates(["doc_id"])
    own = materialise(own.withColumn("bytes", F.octet_length("text")), "abuse-labelled")
    taken, size = [], 0
    for r in own.select("doc_id", "bytes").orderBy(F.xxhash64("doc_id"), "doc_id").collect():  # MOST_LABELLED pairs of numbers
        size += r["bytes"]
        if size > MOST_BYTES:
            break
        taken.append(r["doc_id"])
    rows = (own if len(taken) == MOST_LABELLED or size <= MOST_BYTES else own.where(F.col("doc_id").isin(taken))).orderBy("doc_id").collect()
    targets = ["any", *KINDS] if kinds else ["any"]
    bags = Bags([r["text"] for r in rows])
    out = np.zeros((len(targets), (1 << BITS) + 1))
    for k, name in enumerate(targets):
        y = np.array([r[name] for r in rows])
        if len(y) and 0 < y.sum() < len(y):
            out[k] = train_robust(bags, 0.005 + 0.985 * y)
        else:
            out[k, -1] = -30
    return out


def score(docs: DataFrame, models: np.ndarray) -> DataFrame:
    """(doc_id, score, worst passage[, a score for each kind]) of docs(doc_id, text), whatever its further columns.

    Null and empty texts score 0; repeated rows give one row; an empty table gives an empty result. Texts are scored
    whole, each by one task; nothing is shuffled but the final distinct.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    names = ["score", *KINDS][: len(models)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            values, worst = scores([t or "" for t in b["text"]], shared.value)
            yield pd.DataFrame({"doc_id": b["doc_id"], "passage": worst, **{n: values[:, i] for i, n in enumerate(names)}})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id bigint, passage string, " + ", ".join(f"{n} double" for n in names)).distinct()


def offending_passages(docs: DataFrame, models: np.ndarray, least: float = 0.1) -> DataFrame:
    """(doc_id, place, passage, probability) of the sentences, or windows of longer ones, that are offensive by themselves with at least this probability by the first model; place counts from 0.

    Inputs and edge cases as for :func:`score`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models[0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shared.value
        for b in batches:
            ids, places, parts, at, size = [], [], [], [], []
            for d, t in zip(b["doc_id"], b["text"]):
                for k, p in enumerate(passages(t or "")):
                    f = features(p)
                    at += f
                    size.append(len(f))
                    ids.append(d)
                    places.append(k)
                    parts.append(p)
            row = np.repeat(np.arange(len(parts)), size)
            z = np.bincount(row, weights=w[np.array(at, np.int64)], minlength=len(parts)) + w[-1] if parts else np.zeros(0)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            ok = np.flatnonzero(p >= least)
            yield pd.DataFrame({"doc_id": [ids[i] for i in ok], "place": [places[i] for i in ok], "passage": [parts[i] for i in ok], "probability": p[ok]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id bigint, place int, passage string, probability double").distinct()
