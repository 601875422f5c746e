"""Box geometry as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box_from_points(points: Column) -> Column:
    """Struct (x1, y1, x2, y2), or null when the point list has neither accepted form.

    Two or more points whose first has two coordinates give their bounding box; one
    four-number point is taken as it stands, inverted or not.
    """
    first = F.try_element_at(points, F.lit(1))
    corners = (F.size(points) >= 2) & (F.size(first) == 2)
    compact = (F.size(points) == 1) & (F.size(first) == 4)

    def axis(i: int) -> Column:
        return F.transform(points, lambda p: p[i])

    def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
        return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))

    return F.when(
        corners,
        box(
            F.array_min(axis(0)), F.array_min(axis(1)), F.array_max(axis(0)), F.array_max(axis(1))
        ),
    ).when(compact, box(first[0], first[1], first[2], first[3]))


def is_valid_box(x1="x1", y1="y1", x2="x2", y2="y2") -> Column:
    """Positive width and height, all four numbers finite."""
    cols = [F.col(c) for c in (x1, y1, x2, y2)]
    finite = ~F.isnan(cols[0])
    for c in cols[1:]:
        finite = finite & ~F.isnan(c)
    for c in cols:
        finite = finite & (F.abs(c) < F.lit(float("inf")))
    return (cols[2] > cols[0]) & (cols[3] > cols[1]) & finite


def _side(prefix: str, name: str) -> Column:
    return F.col(f"{prefix}{name}")


def intersects(a: str, b: str) -> Column:
    """True when the boxes with column prefixes ``a`` and ``b`` share a positive area."""
    return (
        (_side(a, "x1") < _side(b, "x2"))
        & (_side(b, "x1") < _side(a, "x2"))
        & (_side(a, "y1") < _side(b, "y2"))
        & (_side(b, "y1") < _side(a, "y2"))
    )


def iou(a: str, b: str) -> Column:
    """Intersection over union of two boxes given by column prefixes; 0 when the union is empty."""
    zero = F.lit(0.0)
    w = F.greatest(
        zero, F.least(_side(a, "x2"), _side(b, "x2")) - F.greatest(_side(a, "x1"), _side(b, "x1"))
    )
    h = F.greatest(
        zero, F.least(_side(a, "y2"), _side(b, "y2")) - F.greatest(_side(a, "y1"), _side(b, "y1"))
    )
    inter = w * h

    def area(p: str) -> Column:
        return F.greatest(zero, _side(p, "x2") - _side(p, "x1")) * F.greatest(
            zero, _side(p, "y2") - _side(p, "y1")
        )

    union = area(a) + area(b) - inter
    return F.when(union > 0, inter / union).otherwise(zero)


def rect_points(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Four rectangle corners, three decimals, clockwise from the top left."""
    a, b, c, d = (F.round(v, 3) for v in (x1, y1, x2, y2))
    return F.array(F.array(a, b), F.array(c, b), F.array(c, d), F.array(a, d))


def scale_points(points: Column, sx: Column, sy: Column) -> Column:
    """Scale every two- or four-number point; any other point is kept unchanged."""
    return F.transform(
        points,
        lambda p: F.when(F.size(p) == 2, F.array(p[0] * sx, p[1] * sy))
        .when(F.size(p) == 4, F.array(p[0] * sx, p[1] * sy, p[2] * sx, p[3] * sy))
        .otherwise(p),
    )


def to_pixels(low: Column, high_x: Column, high_y: Column, size: Column) -> Column:
    """Pixel value of ``low``; boxes that end at or below 2.0 on both axes are normalised ones."""
    return F.when((high_x <= 2.0) & (high_y <= 2.0) & (size > 0), low * size).otherwise(low)


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(high, value))
