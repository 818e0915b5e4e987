"""Two recognisers' lines of one page: matching, choosing, fusing and placing them in the page's text.

Everything joins on (doc_id, page_no), so candidates are the pairs of one page. Only the one-to-one matching, in which
each accepted pair shuts out others, needs a page as a whole in one Arrow function; a page is a bounded group.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import fuzzy
from pagewright.functions import geometry as G
from pagewright.functions import scoring as S
from pagewright.functions import text as T
from pagewright.session import materialise

PAGE = ["doc_id", "page_no"]


def side(lines: DataFrame, engine: str, prefix: str) -> DataFrame:
    """One engine's lines with their place, text, tokens and box under a prefix; k is a line's place on its page."""
    w = Window.partitionBy(*PAGE).orderBy("idx", "line_id")
    rows = lines.where(F.col("engine") == engine)
    return rows.select(*PAGE, (F.row_number().over(w) - 1).alias(f"{prefix}k"), F.col("line_id").alias(f"{prefix}id"), F.col("text").alias(f"{prefix}text"), F.col("confidence").alias(f"{prefix}confidence"), G.hull(F.col("polygon")).alias(f"{prefix}box"), T.normalised(F.col("text")).alias(f"{prefix}norm"))


def geometry_candidates(first: DataFrame, second: DataFrame) -> DataFrame:
    """Pairs of lines of one page whose boxes share a row and touch or lie close, with their overlap."""
    a, b = F.col("abox"), F.col("bbox")
    pairs = first.join(second, PAGE).where("abox IS NOT NULL AND bbox IS NOT NULL").where(G.same_row(a, b))
    overlap = G.overlap_of_smaller(a, b)
    return pairs.withColumns({"overlap": overlap, "gap": G.horizontal_gap(a, b)}).where((F.col("overlap") >= G.TOUCH) | (F.col("gap") <= G.NEAR))


def candidates(first: DataFrame, second: DataFrame) -> DataFrame:
    """Pairs that may be one line, with similarity, overlap and weight."""
    a, b = F.col("abox"), F.col("bbox")
    boxed = a.isNotNull() & b.isNotNull()
    overlap = F.coalesce(F.when(boxed, G.overlap_of_smaller(a, b)), F.lit(0.0))
    row = F.coalesce(F.when(boxed, G.same_row(a, b)), F.lit(False))
    # Where both boxes are known and share no row, no similarity can make a pair, so the costly function isn't asked.
    pairs = first.join(second, PAGE).withColumns({"overlap": overlap, "row": row, "boxed": boxed}).where("NOT boxed OR row")
    near = (F.col("overlap") >= G.TOUCH) | (F.coalesce(G.horizontal_gap(a, b), F.lit(9.0)) <= G.NEAR)
    # Two texts can't be more alike than their lengths; what this leaves too low needs no matching.
    m, n = F.length("anorm"), F.length("bnorm")
    most = F.coalesce(F.try_divide(2.0 * F.least(m, n), m + n), F.lit(0.0)) + 1e-9
    pairs = pairs.where(F.when(F.col("boxed"), ((most >= 0.72) & near) | (F.col("overlap") >= G.COVER)).otherwise(most >= 0.86))
    pairs = pairs.withColumn("similarity", fuzzy.similarity(F.col("anorm"), F.col("bnorm")))
    ok = F.when(F.col("boxed"), ((F.col("similarity") >= 0.72) & near) | (F.col("overlap") >= G.COVER)).otherwise(F.col("similarity") >= 0.86)
    return pairs.where(ok).withColumn("weight", 0.6 * F.col("similarity") + 0.4 * F.col("overlap"))


def match(pairs: DataFrame) -> DataFrame:
    """(doc_id, page_no, ak, bk): the heaviest pair first, then any whose two lines are still free; equal weights go by falling places."""

    def run(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        left, right, out = set(), set(), []
        for w, i, j in sorted(zip(b["weight"], b["ak"], b["bk"]), reverse=True):
            if i not in left and j not in right:
                left.add(i)
                right.add(j)
                out.append((*key, i, j))
        return pd.DataFrame(out, columns=["doc_id", "page_no", "ak", "bk"])

    return pairs.select(*PAGE, "ak", "bk", "weight").groupBy(*PAGE).applyInPandas(run, "doc_id bigint, page_no int, ak int, bk int")


def native_support(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """(line_id, engine, support): the best share of a line's tokens that a region under it confirms; lines without one are missing."""
    mine = lines.select("line_id", "engine", *PAGE, G.hull(F.col("polygon")).alias("box"), T.tokens(F.col("text")).alias("tokens")).where("box IS NOT NULL AND size(tokens) > 0")
    theirs = regions.select(*PAGE, F.col("box").alias("region_box"), T.tokens(F.col("text")).alias("region_tokens")).where("region_box IS NOT NULL AND size(region_tokens) > 0")
    near = mine.join(theirs, PAGE).where(G.overlap_of_first(F.col("box"), F.col("region_box")) >= 0.35)
    return near.withColumn("support", fuzzy.token_support(F.col("tokens"), F.col("region_tokens"))).groupBy("line_id", "engine").agg(F.max("support").alias("support"))


def choose(pairs: DataFrame) -> DataFrame:
    """winner and reason for matched pairs with atext, btext, asupport, bsupport."""
    lead = F.col("asupport") - F.col("bsupport")
    noise = T.noise_score(F.col("atext")), T.noise_score(F.col("btext"))
    same = T.collapsed(F.col("atext")) == T.collapsed(F.col("btext"))
    rules = (
        (lead >= S.SUPPORT_LEAD, "tesseract", "stronger_native_text_support"),
        (-lead >= S.SUPPORT_LEAD, "paddleocr", "stronger_native_text_support"),
        (noise[0] + S.NOISE_LEAD < noise[1], "tesseract", "fewer_suspicious_tokens"),
        (noise[1] + S.NOISE_LEAD < noise[0], "paddleocr", "fewer_suspicious_tokens"),
        (same, "tesseract", "engine_agreement"),
    )
    winner = reason = None
    for test, who, why in rules:
        winner = F.when(test, who) if winner is None else winner.when(test, who)
        reason = F.when(test, why) if reason is None else reason.when(test, why)
    return pairs.withColumns({"same": same, "winner": winner.otherwise("paddleocr"), "reason": reason.otherwise("ambiguous_conflict_defaulted_to_fallback_engine")})


def fuse(lines: DataFrame, regions: DataFrame, page_scores: DataFrame) -> DataFrame:
    """(doc_id, page_no, line_id, engine, source, reason, conflict, place): the lines that a page keeps, in reading order.

    page_scores(doc_id, page_no, first, second): rounded scores of the two engines. Where one engine is clearly better
    its lines are the page; else matched lines are reduced to the better one and the others of both engines stay.
    """
    # Each is used several times: written once instead of made again.
    first, second = materialise(side(lines, "tesseract", "a"), "fuse-first"), materialise(side(lines, "paddleocr", "b"), "fuse-second")
    pairs = materialise(match(candidates(first, second)), "fuse-pairs")
    support = native_support(lines, regions)
    matched = pairs.join(first, [*PAGE, "ak"]).join(second, [*PAGE, "bk"])
    for p, e in (("a", "tesseract"), ("b", "paddleocr")):
        matched = matched.join(support.where(F.col("engine") == e).select(F.col("line_id").alias(f"{p}id"), F.col("support").alias(f"{p}support")), f"{p}id", "left")
    chosen = choose(matched)
    win = F.col("winner") == "tesseract"
    cols = lambda place, box, k: [F.coalesce(F.col(box).t, F.lit(2.0)).alias("top"), F.coalesce(F.col(box).l, F.lit(2.0)).alias("left"), k.alias("k")]
    best = chosen.withColumn("box", F.when(win, F.col("abox")).otherwise(F.col("bbox")))
    both = best.select(*PAGE, F.when(win, F.col("aid")).otherwise(F.col("bid")).alias("line_id"), F.col("winner").alias("engine"), F.when(F.col("same"), "both").otherwise(F.col("winner")).alias("source"), "reason", (~F.col("same")).alias("conflict"), *cols("", "box", F.least("ak", "bk")))
    rest = []
    for p, e, rows in (("a", "tesseract", first), ("b", "paddleocr", second)):
        alone = rows.join(pairs.select(*PAGE, f"{p}k"), [*PAGE, f"{p}k"], "left_anti")
        rest.append(alone.select(*PAGE, F.col(f"{p}id").alias("line_id"), F.lit(e).alias("engine"), F.lit(e).alias("source"), F.lit(None).cast("string").alias("reason"), F.lit(False).alias("conflict"), *cols("", f"{p}box", F.col(f"{p}k"))))
    merged = both.unionByName(rest[0]).unionByName(rest[1])
    prefer = page_scores.select(*PAGE, S.preferred_engine(F.col("first"), F.col("second")).alias("preferred")).where("preferred IS NOT NULL")
    whole = [rows.join(prefer.where(F.col("preferred") == e), PAGE).select(*PAGE, F.col(f"{p}id").alias("line_id"), F.lit(e).alias("engine"), F.lit(e).alias("source"), F.lit("higher_page_quality").alias("reason"), F.lit(False).alias("conflict"), F.lit(0.0).alias("top"), F.lit(0.0).alias("left"), F.col(f"{p}k").alias("k")) for p, e, rows in (("a", "tesseract", first), ("b", "paddleocr", second))]
    kept = merged.join(prefer, PAGE, "left_anti").unionByName(whole[0]).unionByName(whole[1])
    w = Window.partitionBy(*PAGE).orderBy("top", "left", "k", "source", "line_id")
    return kept.withColumn("place", F.row_number().over(w)).select(*PAGE, "line_id", "engine", "source", "reason", "conflict", "place")


def fusion_counts(fused: DataFrame) -> DataFrame:
    """What each page took from where."""
    n = lambda s: F.count_if(F.col("source") == s)
    return fused.groupBy(*PAGE).agg(F.count("*").alias("lines"), n("tesseract").alias("selected_from_tesseract"), n("paddleocr").alias("selected_from_paddle"), n("both").alias("agreed"), F.count_if("conflict").alias("conflicts"))


def assemble(pages: DataFrame, lines: DataFrame, regions: DataFrame) -> DataFrame:
    """(doc_id, page_no, text) of pages(doc_id, page_no, text): the text of each page as it is published.

    A page without lines keeps its native text; where that can't be trusted, its lines stand instead; else the lines it
    doesn't hold follow it, under a header. Repeated pages give one row; null texts count as empty. Lines are gathered
    by page, which is a bounded group.
    """
    own = pages.select(*PAGE, F.coalesce("text", F.lit("")).alias("text"))
    seen = lines.where("text IS NOT NULL").select("line_id", *PAGE, "idx", "text", "polygon")
    open_ = uncovered(seen, regions, own).withColumn("open", F.lit(True))
    line = F.concat(G.position_label(G.hull(F.col("polygon"))), F.lit(" "), "text")
    rows = seen.join(open_, "line_id", "left").groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("idx", "line_id", line.alias("line"), "open"))).alias("items"))
    section = lambda header, items: F.array_join(F.concat(F.array(F.lit(header)), F.transform(items, lambda s: s.line)), "\n")
    more = F.filter("items", lambda s: s.open)
    text = F.when(F.col("items").isNull(), F.col("text")).when(F.size(T.reasons(F.col("text"))) > 0, section(T.SECTIONS[0], F.col("items"))).when(F.size(more) > 0, F.concat_ws("\n\n", "text", section(T.SECTIONS[1], more))).otherwise(F.col("text"))
    return own.join(rows, PAGE, "left").select(*PAGE, text.alias("text")).distinct()


def uncovered(lines: DataFrame, regions: DataFrame, pages: DataFrame) -> DataFrame:
    """(line_id) of lines that the native text doesn't hold.

    A line with a box is covered by a region over half of it that has alike text; a line without one by the page's
    text, as a run of at least eight characters or as tokens; lines without letters and digits are never asked for.
    """
    word = lambda c: F.transform(T.words(c), T.casefold)
    compact = lambda c: T.casefold(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))
    rows = lines.select("line_id", *PAGE, G.hull(F.col("polygon")).alias("box"), word(F.col("text")).alias("tokens"), compact(F.col("text")).alias("compact")).where("compact <> ''")
    theirs = regions.select(*PAGE, F.col("box").alias("region_box"), word(F.col("text")).alias("region_tokens")).where("region_box IS NOT NULL")
    near = rows.where("box IS NOT NULL").join(theirs, PAGE).where(G.overlap_of_first(F.col("box"), F.col("region_box")) >= 0.5)
    hidden = fuzzy.similar_in_region(near, "line_id", "tokens", "region_tokens")
    bare = rows.where("box IS NULL").join(pages.select(*PAGE, word(F.col("text")).alias("h"), compact(F.col("text")).alias("hc")), PAGE)
    seen = bare.where(((F.length("compact") >= 8) & F.contains("hc", "compact")) | T.contains_sequence(F.col("h"), F.col("tokens"))).select("line_id")
    return rows.select("line_id").join(hidden.unionByName(seen), "line_id", "left_anti")
