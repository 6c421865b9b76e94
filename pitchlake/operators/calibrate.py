"""Calibration: the homography from pixels to metres, and positions on the pitch."""

from __future__ import annotations

import logging
import math
import random
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import with_nulls
from ..functions.geometry import ground_point, matrix_of, on_pitch, project, rate, seconds

INLIER_M, WARN_M, WARN_ON_PITCH = 1.0, 2.0, 0.9
#: Fours of landmark pairs that are tried at most, in an order that is drawn with a fixed seed.
FOURS, SEED = 4845, 7
log = logging.getLogger(__name__)

Pair = tuple[tuple[float, float], tuple[float, float]]


def _normalised(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    centre = points.mean(axis=0)
    scale = np.sqrt(2) / max(1e-12, float(np.linalg.norm(points - centre, axis=1).mean()))
    t = np.array([[scale, 0, -scale * centre[0]], [0, scale, -scale * centre[1]], [0, 0, 1]])
    return (points - centre) * scale, t


def _direct(pixels: np.ndarray, metres: np.ndarray) -> np.ndarray | None:
    """The homography of least algebraic error, or None where points lie on a line."""
    (p, tp), (m, tm) = _normalised(pixels), _normalised(metres)
    rows = []
    for (x, y), (u, v) in zip(p, m, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y, -u], [0, 0, 0, x, y, 1, -v * x, -v * y, -v]]
    _, s, vt = np.linalg.svd(np.array(rows))
    if s[7] < 1e-9 * s[0]:
        return None
    h = np.linalg.inv(tm) @ vt[-1].reshape(3, 3) @ tp
    return h / h[2, 2] if abs(h[2, 2]) > 1e-12 else None


def _residuals(h: np.ndarray, pixels: np.ndarray, metres: np.ndarray) -> np.ndarray:
    q = np.column_stack([pixels, np.ones(len(pixels))]) @ h.T
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.linalg.norm(q[:, :2] / q[:, 2:] - metres, axis=1)
    return np.where(np.isfinite(r), r, np.inf)


def _fours(n: int) -> Iterator[list[int]]:
    """The first FOURS of all fours of n places, in a drawn order; all where there are no more."""
    total = math.comb(n, 4)
    for rank in random.Random(SEED).sample(range(total), min(FOURS, total)):
        four = []
        for left in (4, 3, 2, 1):
            at = max(k for k in range(left - 1, n) if math.comb(k, left) <= rank)
            four.append(at)
            rank -= math.comb(at, left)
        yield four


def solve_homography(pairs: Sequence[Pair], inlier_m: float = INLIER_M) -> tuple[np.ndarray, float]:
    """(homography, error) from ((pixel x, y), (metre x, y)) pairs, four or more.

    Of the homographies of fours of pairs (see _fours: one rule for any number of pairs) the
    one that most pairs agree with within inlier_m is refitted to those; error is their largest residual in metres, or all pairs'
    if none agree. Pairs that don't agree are reported. This runs on the driver: a pitch has
    a dozen landmarks.
    """
    if len(pairs) < 4:
        raise ValueError(f"a homography needs at least 4 landmark pairs, not {len(pairs)}")
    pixels, metres = (np.array([p[i] for p in pairs], dtype=np.float64) for i in (0, 1))
    best = None
    for four in _fours(len(pairs)):
        h = _direct(pixels[four], metres[four])
        if h is None:
            continue
        r = _residuals(h, pixels, metres)
        inliers = r <= inlier_m
        rank = (int(inliers.sum()), -float(r[inliers].sum()))
        if best is None or rank > best[0]:
            best = (rank, inliers)
    fitted = _direct(pixels[best[1]], metres[best[1]]) if best and best[1].sum() >= 4 else None
    if fitted is None:
        raise ValueError("no homography fits the landmark pairs")
    r = _residuals(fitted, pixels, metres)
    inliers = r <= inlier_m
    if not inliers.all():
        log.warning("%d landmark pairs don't fit: %s", int((~inliers).sum()), [i for i, ok in enumerate(inliers) if not ok])
    error = float(r[inliers].max() if inliers.any() else r.max())
    if error > WARN_M:
        log.warning("calibration error of %.2f m", error)
    return fitted, error


def homography_for(config: dict, saved: dict | None) -> list[list[float]] | None:
    """The matrix that a camera's section asks for, or its part `homography` if it has one:
    mode `static` uses the saved one, `per_frame` (the default) has none, and so does
    `static` before anything is saved."""
    config = config.get("homography") or config
    if config.get("mode", "per_frame") != "static":
        log.warning("per-frame calibration is not available: metres stay null")
        return None
    return (saved or {}).get("homography")


def calibrate(tracks_px: DataFrame, fps: float | None = 25.0, homography: Sequence[Sequence[float]] | None = None) -> DataFrame:
    """tracks_px with t_s, x_m and y_m (null without a homography), speed_ms still null, and
    team, shirt and player null where the stages that give them were skipped."""
    filled = with_nulls(tracks_px, team="string", shirt="short", player="string", speed_ms="double")
    x, y = project(*ground_point(), homography) if homography is not None else (F.lit(None).cast("double"),) * 2
    return filled.withColumns({"t_s": seconds(F.col("frame"), fps), "x_m": x, "y_m": y})


def calibrate_matches(tracks_px: DataFrame, cameras: DataFrame, fps: float | None = 25.0, homography: Sequence[Sequence[float]] | None = None) -> DataFrame:
    """As calibrate, for many matches: cameras is (match_id, h array<double> of 9 by rows, and
    fps if rates differ), one row a match. What is null there, and matches without a row, take the other
    arguments; matches without any homography stay without metres."""
    filled = with_nulls(tracks_px, team="string", shirt="short", player="string", speed_ms="double")
    own = with_nulls(cameras, fps="double").select("match_id", F.nullif(F.col("fps").cast("double"), F.lit(0.0)).alias("__fps"), F.col("h").alias("__h"))
    x, y = project(*ground_point(), matrix_of("__h", homography))
    t_s = seconds(F.col("frame"), F.coalesce("__fps", rate(fps)))
    return filled.join(own, "match_id", "left").withColumns({"t_s": t_s, "x_m": x, "y_m": y}).drop("__fps", "__h")


def fraction_on_pitch(tracks_m: DataFrame) -> DataFrame:
    """For each match the share of rows on the pitch, to 3 digits; null without any metres."""
    inside = on_pitch(F.col("x_m"), F.col("y_m")).cast("int")
    share = F.when(F.max(F.col("x_m").isNotNull()), F.bround(F.avg(inside), 3))
    return tracks_m.groupBy("match_id").agg(share.alias("fraction_on_pitch")).withColumn("low", F.col("fraction_on_pitch") < WARN_ON_PITCH)
