"""Mixing sources to target shares of tokens.

Method: entropy balancing. Of all document rates that give each source its tokens and stay within its most repeats,
those are taken that are nearest to 1 in relative entropy: rates min(repeats, exp(lambda tokens / mean)), with one
lambda a source. The lambdas solve a convex dual by Newton steps. A step needs two sums for each source, which all
executors add up over the table of (source, tokens, documents); no documents are moved. Rates are then rounded to
copies: whole parts, and one more for a share of the documents chosen by a hash, so that tokens come out right.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import materialise

#: Places of the hash that rounding may be moved to, by source; Newton steps at most.
BINS, STEPS = 8192, 60


def default_tokenizer() -> str:
    """The vocabulary file that queries use where none is given."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_loaded: dict = {}


def encoding(path: str):
    """A tiktoken encoding from a file of ranks, once a worker."""
    if path not in _loaded:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, source, tokens) of docs(doc_id, source, text); null texts have 0 tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(tokenizer)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "tokens": n})

    return docs.select("doc_id", "source", "text").mapInPandas(run, "doc_id bigint, source string, tokens bigint")


def _by_source(values: dict[str, float]):
    """A column that is a number for each source."""
    return F.element_at(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(float(v)))]), F.col("source"))


def mix(docs: DataFrame, targets: DataFrame, tokenizer: str, total: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(copies, shares) of docs(doc_id, source, text) for targets(source, target_share, max_repeats); further columns don't matter.

    copies (doc_id, source, tokens, rate, copies): each document of a source with a target, also where it isn't taken.
    shares (source, target_share, share, tokens, documents, copies, max_repeats): what is reached; a target without
    tokens gets 0, and the others keep their proportions. total: tokens wanted; None for the most that the repeats
    allow, and never more than that. Documents of null or other sources are left out; null and empty texts have no
    copies; doc_ids that come twice count once. targets is a small table of one row a source; empty tables give empty
    copies, and shares of 0.
    """
    aims = {r["source"]: (r["target_share"], r["max_repeats"]) for r in targets.select("source", "target_share", "max_repeats").distinct().collect() if r["source"] is not None and r["target_share"] and r["max_repeats"]}
    wanted = docs.select("doc_id", "source", "text").where(F.col("source").isin(list(aims)) if aims else F.lit(False))
    # Repeated rows are dropped from the counts, not from the texts, which are never shuffled.
    sized = materialise(token_counts(wanted, tokenizer).dropDuplicates(["doc_id"]), "mix-tokens")
    sizes = materialise(sized.where("tokens > 0").groupBy("source", "tokens").agg(F.count("*").alias("n")), "mix-sizes")
    held = {r["source"]: (r["tokens"], r["n"]) for r in sizes.groupBy("source").agg(F.sum(F.col("tokens") * F.col("n")).alias("tokens"), F.sum("n").alias("n")).collect()}
    whole = sum(aims[s][0] for s in held) or 1.0
    share = {s: aims[s][0] / whole for s in held}
    most = min((aims[s][1] * held[s][0] / share[s] for s in held), default=0.0)
    goal = {s: share[s] * min(total or most, most) for s in held}
    lambdas = _solve(sizes, held, goal, {s: aims[s][1] for s in held})
    if not held:
        taken = sized.select("doc_id", "source", "tokens", F.lit(0.0).alias("rate"), F.lit(0).cast("bigint").alias("copies"))
        return taken, _shares(taken, targets)
    cap = _by_source({s: aims[s][1] for s in held})
    scale = _by_source({s: lambdas[s] * held[s][1] / held[s][0] for s in held})
    rate = F.when(F.col("tokens") > 0, F.least(cap, F.exp(F.least(scale * F.col("tokens"), F.lit(50.0))))).otherwise(0.0)
    # v: how far a document's fraction is beyond its place; moved by source until the tokens are right.
    place = (F.xxhash64("doc_id", F.lit("copies")).bitwiseAND(0xFFFFFFFF) + 0.5) / float(1 << 32)
    rated = sized.where(F.col("source").isin(list(held))).withColumn("rate", rate).withColumn("whole", F.floor("rate"))
    rated = rated.withColumn("bin", F.floor((F.col("rate") - F.col("whole") - place + 1) / 2 * BINS)).withColumn("more", (F.col("whole") < cap) & (F.col("tokens") > 0))
    sums = rated.groupBy("source", "bin").agg(F.sum(F.col("whole") * F.col("tokens")).alias("base"), F.sum(F.when(F.col("more"), F.col("tokens")).otherwise(0)).alias("extra"))
    bound = _bounds(sums.collect(), goal)  # at most sources x BINS rows
    taken = rated.withColumn("copies", (F.col("whole") + F.when(F.col("more") & (F.col("bin") >= _by_source(bound)), 1).otherwise(0)).cast("bigint"))
    taken = taken.select("doc_id", "source", "tokens", "rate", "copies")
    return taken, _shares(taken, targets)


def _solve(sizes: DataFrame, held: dict, goal: dict, cap: dict) -> dict[str, float]:
    """Newton on the dual, kept between bounds that close in; all sources at a time."""
    low, high, now = ({s: v for s in held} for v in (-60.0, 60.0, 0.0))
    open_ = {s for s in held if goal[s] < cap[s] * held[s][0] * (1 - 1e-9)}
    out = {s: 60.0 for s in held}
    for _ in range(STEPS):
        if not open_:
            break
        mean = {s: held[s][0] / held[s][1] for s in open_}
        rows = sizes.where(F.col("source").isin(list(open_))).withColumn("x", F.col("tokens") / _by_source(mean))
        e = F.exp(F.least(F.lit(50.0), _by_source({s: now[s] for s in open_}) * F.col("x")))
        free = e < _by_source(cap)
        mass = F.col("tokens") * F.col("n")
        sums = rows.groupBy("source").agg(F.sum(F.least(e, _by_source(cap)) * mass).alias("g"), F.sum(F.when(free, e * F.col("x") * mass).otherwise(0)).alias("h")).collect()
        for r in sums:
            s, miss = r["source"], r["g"] - goal[r["source"]]
            out[s] = now[s]
            if abs(miss) <= 1e-6 * max(goal[s], 1):
                open_.discard(s)
                continue
            if miss > 0:
                high[s] = now[s]
            else:
                low[s] = now[s]
            step = now[s] - miss / r["h"] if r["h"] > 0 else float("nan")
            now[s] = step if low[s] < step < high[s] else (low[s] + high[s]) / 2
            if high[s] - low[s] < 1e-12:
                open_.discard(s)
    return out


def _bounds(rows: list, goal: dict[str, float]) -> dict[str, float]:
    """The first bin that is rounded up, by source, so that the tokens come nearest to the goal."""
    out = {}
    for s in goal:
        own = sorted(((r["bin"], r["extra"]) for r in rows if r["source"] == s), reverse=True)
        have = float(sum(r["base"] for r in rows if r["source"] == s))
        best, at = abs(have - goal[s]), BINS + 1
        for b, extra in own:
            have += extra
            if abs(have - goal[s]) < best:
                best, at = abs(have - goal[s]), b
        out[s] = at
    return out


def _shares(taken: DataFrame, targets: DataFrame) -> DataFrame:
    total = F.sum(F.col("tokens") * F.col("copies"))
    got = taken.groupBy("source").agg(total.alias("tokens"), F.count_if(F.col("copies") > 0).alias("documents"), F.sum("copies").alias("copies"))
    wanted = targets.select("source", "target_share", "max_repeats").distinct()
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("tokens", "documents", "copies")]
    rows = wanted.join(got, "source", "left").select("source", "target_share", "max_repeats", *zero)
    whole = rows.agg(F.sum("tokens").alias("whole"))
    return rows.join(F.broadcast(whole)).select("source", "target_share", F.coalesce(F.try_divide("tokens", "whole"), F.lit(0.0)).alias("share"), "tokens", "documents", "copies", "max_repeats")
