"""Boxes are structs (l, t, r, b) in parts of a page, its top left being the origin."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bounds of positions, of rows and of overlaps that are a match.
SAME_ROW, NEAR, TOUCH, COVER = 0.45, 0.04, 0.15, 0.45


def box(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    return F.struct(left.alias("l"), top.alias("t"), right.alias("r"), bottom.alias("b"))


def unit(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def _finite(*cs: Column) -> Column:
    ok = F.lit(True)
    for c in cs:
        ok = ok & c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    return ok


def normal_polygon(polygon: Column, width: Column, height: Column) -> Column:
    """Points in parts of the page; null with fewer than three points, a point that isn't finite, or a page without size."""
    points = F.transform(polygon, lambda p: F.struct(unit(p.x / width).alias("x"), unit(p.y / height).alias("y")))
    ok = (F.size(polygon) >= 3) & F.forall(polygon, lambda p: _finite(p.x, p.y)) & (width > 0) & (height > 0)
    return F.when(ok, points)


def hull(polygon: Column, degenerate: bool = False) -> Column:
    """The box around a polygon; null without points and, unless `degenerate`, without area."""
    xs, ys = F.transform(polygon, lambda p: p.x), F.transform(polygon, lambda p: p.y)
    made = box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
    ok = F.size(polygon) > 0
    return F.when(ok if degenerate else ok & (made.r > made.l) & (made.b > made.t), made)


def normal_box(b: Column, width: Column, height: Column, bottom_left: Column) -> Column:
    """A native box in parts of the page; null if it isn't finite, has no area or the page has no size."""
    top = F.when(bottom_left, (height - b.t) / height).otherwise(b.t / height)
    low = F.when(bottom_left, (height - b.b) / height).otherwise(b.b / height)
    x, y, z, w = unit(b.l / width), unit(b.r / width), unit(top), unit(low)
    made = box(F.least(x, y), F.least(z, w), F.greatest(x, y), F.greatest(z, w))
    ok = _finite(b.l, b.t, b.r, b.b) & (width > 0) & (height > 0)
    return F.when(ok & (made.r > made.l) & (made.b > made.t), made)


def area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b.r - b.l) * F.greatest(F.lit(0.0), b.b - b.t)


def intersection(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a.r, b.r) - F.greatest(a.l, b.l)) * F.greatest(F.lit(0.0), F.least(a.b, b.b) - F.greatest(a.t, b.t))


def overlap_of_first(a: Column, b: Column) -> Column:
    return F.when(area(a) > 0, intersection(a, b) / area(a)).otherwise(F.lit(0.0))


def overlap_of_smaller(a: Column, b: Column) -> Column:
    least = F.least(area(a), area(b))
    return F.when(least > 0, intersection(a, b) / least).otherwise(F.lit(0.0))


def same_row(a: Column, b: Column) -> Column:
    shared = F.greatest(F.lit(0.0), F.least(a.b, b.b) - F.greatest(a.t, b.t))
    height = F.least(a.b - a.t, b.b - b.t)
    return F.coalesce((height > 0) & (shared / height >= SAME_ROW), F.lit(False))


def horizontal_gap(a: Column, b: Column) -> Column:
    return F.when(a.r < b.l, b.l - a.r).when(b.r < a.l, a.l - b.r).otherwise(F.lit(0.0))


def reading_key(b: Column, idx: Column) -> list[Column]:
    """Sort key from top to bottom, then left to right; lines without a box come last."""
    return [F.coalesce(b.t, F.lit(2.0)), F.coalesce(b.l, F.lit(2.0)), idx]


def rounded(b: Column) -> Column:
    return F.when(b.isNotNull(), F.array(*[F.round(x, 6) for x in (b.l, b.t, b.r, b.b)]))


def position_label(b: Column) -> Column:
    """How a line's place is written in transcripts."""
    return F.when(b.isNull(), F.lit("[position unavailable]")).otherwise(F.format_string("[x=%.3f..%.3f, y=%.3f..%.3f]", b.l, b.r, b.t, b.b))
