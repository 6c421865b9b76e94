"""Column expressions of the pitch and the image."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The pitch and its goals in metres.
PITCH_LENGTH_M, PITCH_WIDTH_M = 105.0, 68.0
GOAL_X_M, GOAL_Y_M, GOAL_WIDTH_M = 105.0, 34.0, 7.32

# Landmarks of a 105 x 68 pitch in metres, origin at the bottom left.
LANDMARKS = {
    "corner_bottom_left": (0.0, 0.0),
    "corner_top_left": (0.0, 68.0),
    "corner_bottom_right": (105.0, 0.0),
    "corner_top_right": (105.0, 68.0),
    "centre_spot": (52.5, 34.0),
    "halfway_bottom": (52.5, 0.0),
    "halfway_top": (52.5, 68.0),
    "left_box_bottom": (16.5, 13.84),
    "left_box_top": (16.5, 54.16),
    "right_box_bottom": (88.5, 13.84),
    "right_box_top": (88.5, 54.16),
}


def distance(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def ground_point() -> tuple[Column, Column]:
    """Where a box touches the ground: the middle of its lower edge."""
    return (F.col("x1") + F.col("x2")) / 2, F.col("y2")


def box_centre() -> tuple[Column, Column]:
    return (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2


def matrix_of(h: str, otherwise: Sequence[Sequence[float]] | None = None) -> list[list[Column]]:
    """The homography in an array column of 9 numbers by rows; where it is null, another."""
    other = [F.lit(float(v)) for row in otherwise for v in row] if otherwise is not None else [F.lit(None).cast("double")] * 9
    return [[F.when(F.col(h).isNull(), other[3 * i + j]).otherwise(F.get(h, F.lit(3 * i + j))) for j in range(3)] for i in range(3)]


def project(x: Column, y: Column, h: Sequence[Sequence[float]] | Sequence[Sequence[Column]]) -> tuple[Column, Column]:
    """A point through a homography of numbers or columns; null on the horizon."""
    row = [[v if isinstance(v, Column) else F.lit(float(v)) for v in r] for r in h]
    u, v, w = (r[0] * x + r[1] * y + r[2] for r in row)
    w = F.nullif(w, F.lit(0.0))
    return u / w, v / w


def rate(fps: float | Column | None) -> Column:
    """Frames a second, of a number or a column; 0 or none counts as 25."""
    return F.coalesce(F.nullif(fps.cast("double"), F.lit(0.0)), F.lit(25.0)) if isinstance(fps, Column) else F.lit(float(fps or 25.0))


def seconds(frame: Column, fps: float | Column | None) -> Column:
    """Seconds since the start; a rate of 0 or none counts as 25 frames a second."""
    return frame / rate(fps)


def on_pitch(x: Column, y: Column, margin: float = 3.0, length: float = PITCH_LENGTH_M, width: float = PITCH_WIDTH_M) -> Column:
    """Whether a point is on the pitch or up to margin beyond it; unknown points are not."""
    return F.coalesce(x.between(-margin, length + margin) & y.between(-margin, width + margin), F.lit(False))


def shot_distance() -> Column:
    return distance(GOAL_X_M - F.col("start_x"), GOAL_Y_M - F.col("start_y"))


def shot_angle() -> Column:
    """The angle that the goal's posts span, seen from the shot."""
    dx, dy = GOAL_X_M - F.col("start_x"), GOAL_Y_M - F.col("start_y")
    angle = F.atan2(F.lit(GOAL_WIDTH_M) * dx, dx * dx + dy * dy - F.lit((GOAL_WIDTH_M / 2) ** 2))
    return F.when(angle < 0, angle + F.lit(3.141592653589793)).otherwise(angle)


def chroma_of_hex(colour: Column) -> tuple[Column, Column]:
    """The a and b of a colour like #A0B1C2 in the CIE Lab space, offset by 128."""
    digits = F.ltrim(colour, F.lit("#"))
    rgb = [F.conv(F.substring(digits, i, 2), 16, 10).cast("double") / 255 for i in (1, 3, 5)]
    r, g, b = (F.when(c > 0.04045, F.pow((c + 0.055) / 1.055, F.lit(2.4))).otherwise(c / 12.92) for c in rgb)
    # sRGB to XYZ, relative to the D65 white.
    x = (0.412453 * r + 0.357580 * g + 0.180423 * b) / 0.950456
    y = 0.212671 * r + 0.715160 * g + 0.072169 * b
    z = (0.019334 * r + 0.119193 * g + 0.950227 * b) / 1.088754
    fx, fy, fz = (F.when(t > 0.008856, F.cbrt(t)).otherwise(7.787 * t + 16 / 116) for t in (x, y, z))
    return F.round(500 * (fx - fy) + 128), F.round(200 * (fy - fz) + 128)
