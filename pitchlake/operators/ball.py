"""The ball's trajectory: best candidates, a speed gate, short gaps filled."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import PITCH_LENGTH_M, box_centre, distance, matrix_of, project, rate, seconds

MAX_SPEED_MS, REACQUIRE_S, MAX_GAP = 45.0, 1.0, 12
#: The gate's slack: camera motion adds to the ball's own.
SLACK = 1.5


def best_candidates(detections: DataFrame) -> DataFrame:
    """The surest ball of each frame, ties to the smaller det_id: match_id, frame, x_px, y_px, conf."""
    x, y = box_centre()
    balls = detections.where("cls = 'ball'")
    best = F.max_by(F.struct(x.alias("x_px"), y.alias("y_px"), "conf"), F.struct("conf", -F.col("det_id")))
    return balls.groupBy("match_id", "frame").agg(best.alias("best")).select("match_id", "frame", "best.*")


def gate_limit(image_width: float | Column, max_speed_ms: float = MAX_SPEED_MS, pitch_length_m: float = PITCH_LENGTH_M) -> float | Column:
    """Pixels a second that a ball can make, if the pitch spans the image."""
    return max_speed_ms * (image_width / pitch_length_m) * SLACK


def islands(candidates: DataFrame, fps: float | Column, reacquire_s: float = REACQUIRE_S) -> DataFrame:
    """candidates with island: a gap of more than reacquire_s since the candidate before
    accepts the next one whatever was accepted, so islands can be gated apart."""
    order = Window.partitionBy("match_id").orderBy("frame")
    far = (F.col("frame") - F.lag("frame").over(order)) / rate(fps) > reacquire_s
    return candidates.withColumn("island", F.sum(F.coalesce(far, F.lit(False)).cast("int")).over(order))


def speed_gate(candidates: DataFrame, fps: float | Column, max_px_per_s: float | Column, reacquire_s: float = REACQUIRE_S) -> DataFrame:
    """candidates with accepted. One is accepted if it is the first, if more than
    reacquire_s have passed since the last accepted one, or if its speed from there is at
    most max_px_per_s; no time passed is a rejection. Rate and speed are numbers, or
    expressions over candidates that are the same in all of a match."""

    def gate(island: pd.DataFrame) -> pd.DataFrame:
        rows = island.sort_values("frame", kind="stable")
        a_second, limit = float(rows["fps"].iloc[0]), float(rows["most"].iloc[0])
        accepted, last = [], None
        for frame, x, y in zip(rows["frame"], rows["x_px"], rows["y_px"], strict=True):
            ok = last is None
            if not ok:
                dt = (frame - last[0]) / a_second
                way = ((x - last[1]) ** 2 + (y - last[2]) ** 2) ** 0.5
                ok = dt > 0 and (dt > reacquire_s or way / dt <= limit)
            accepted.append(ok)
            if ok:
                last = (frame, x, y)
        return rows.assign(accepted=accepted)[["match_id", "frame", "x_px", "y_px", "conf", "accepted"]]

    schema = "match_id string, frame long, x_px double, y_px double, conf double, accepted boolean"
    most = max_px_per_s if isinstance(max_px_per_s, Column) else F.lit(float(max_px_per_s))
    rows = islands(candidates, fps, reacquire_s).select(
        "match_id", "frame", *(F.col(c).cast("double").alias(c) for c in ("x_px", "y_px", "conf")), "island", rate(fps).alias("fps"), most.cast("double").alias("most")
    )
    return rows.groupBy("match_id", "island").applyInPandas(gate, schema)


def frame_grid(detections: DataFrame) -> DataFrame:
    """A grid for runs that kept none and read every frame: each match's frames from the first
    with a box to the last, all of them."""
    span = detections.groupBy("match_id").agg(F.min("frame").alias("low"), F.max("frame").alias("high"))
    return span.select("match_id", F.posexplode(F.sequence("low", "high")).alias("pos", "frame")).withColumn("pos", F.col("pos").cast("long"))


def processed_grid(frames: DataFrame) -> DataFrame:
    """The grid (match_id, pos, frame) of the distinct frames that a run has read."""
    place = F.row_number().over(Window.partitionBy("match_id").orderBy("frame")).cast("long") - 1
    return frames.select("match_id", "frame").distinct().withColumn("pos", place).select("match_id", "pos", "frame")


def off_grid(points: DataFrame, grid: DataFrame) -> DataFrame:
    """Points whose frame the grid lacks; there should be none."""
    return points.join(grid, ["match_id", "frame"], "left_anti")


def fill_gaps(points: DataFrame, grid: DataFrame, max_gap: int = MAX_GAP) -> DataFrame:
    """points, and between consecutive ones up to max_gap grid places apart a straight line
    of interpolated points with null conf. Longer gaps stay. Each point brings the places
    since the one before it, itself the last, so points are made once for both."""
    on_grid = points.select("match_id", "frame", "x_px", "y_px", "conf").join(grid, ["match_id", "frame"])
    order = Window.partitionBy("match_id").orderBy("frame")
    before = {f"{c}_0": F.lag(c).over(order) for c in ("pos", "x_px", "y_px")}
    linked = on_grid.withColumns(before).withColumn("gap", F.col("pos") - F.col("pos_0"))
    short = F.coalesce((F.col("gap") > 1) & (F.col("gap") <= max_gap), F.lit(False))
    back = F.when(short, F.col("gap") - 1).otherwise(F.lit(0).cast("long"))
    placed = linked.withColumn("back", F.explode(F.sequence(back, F.lit(0).cast("long"), F.lit(-1).cast("long"))))
    made = F.col("back") > 0
    part = (F.col("gap") - F.col("back")) / F.col("gap")
    line = {c: F.when(made, F.col(f"{c}_0") + part * (F.col(c) - F.col(f"{c}_0"))).otherwise(F.col(c)) for c in ("x_px", "y_px")}
    return (
        placed.select("match_id", (F.col("pos") - F.col("back")).alias("pos"), *(v.alias(k) for k, v in line.items()), F.when(~made, F.col("conf")).alias("conf"), made.alias("interpolated"))
        .join(grid, ["match_id", "pos"])
        .select("match_id", "frame", "x_px", "y_px", "conf", "interpolated")
    )


def trajectory(
    detections: DataFrame,
    grid: DataFrame,
    fps: float = 25.0,
    image_width: float = 1280.0,
    homography: Sequence[Sequence[float]] | None = None,
    max_gap: int = MAX_GAP,
    reacquire_s: float = REACQUIRE_S,
    max_speed_ms: float = MAX_SPEED_MS,
    pitch_length_m: float = PITCH_LENGTH_M,
    cameras: DataFrame | None = None,
) -> DataFrame:
    """The ball table: gated and filled points with t_s and, where calibrated, metres.

    cameras (match_id, fps, image_width, h: array of 9 by rows) has a row for each match that
    differs; nulls in it, and matches without a row, take the other arguments."""
    matrix = homography
    best = best_candidates(detections)
    if cameras is None:
        kept = speed_gate(best, fps, gate_limit(image_width, max_speed_ms, pitch_length_m), reacquire_s).where("accepted")
        points = fill_gaps(kept, grid, max_gap).withColumn("t_s", seconds(F.col("frame"), fps))
    else:
        own = cameras.select("match_id", F.nullif(F.col("fps").cast("double"), F.lit(0.0)).alias("__fps"), F.col("image_width").cast("double").alias("__width"), F.col("h").alias("__h"))
        best = best.join(own, "match_id", "left")
        width = F.coalesce("__width", F.lit(float(image_width)))
        kept = speed_gate(best, F.coalesce("__fps", rate(fps)), gate_limit(width, max_speed_ms, pitch_length_m), reacquire_s).where("accepted")
        points = fill_gaps(kept, grid, max_gap).join(own, "match_id", "left").withColumn("t_s", seconds(F.col("frame"), F.coalesce("__fps", rate(fps))))
        matrix = matrix_of("__h", homography)
    x, y = project(F.col("x_px"), F.col("y_px"), matrix) if matrix is not None else (F.lit(None).cast("double"),) * 2
    return points.withColumns({"x_m": x, "y_m": y}).drop("__fps", "__width", "__h")


def coverage(points: DataFrame, grid: DataFrame) -> DataFrame:
    """For each match of the grid the share of its frames that have a ball, to 3 digits."""
    n = grid.groupBy("match_id").agg(F.count(F.lit(1)).alias("n_frames"))
    found = points.groupBy("match_id").agg(F.count(F.lit(1)).alias("n_points"), F.count_if("interpolated").alias("n_interpolated"))
    zero = F.lit(0).cast("long")
    return n.join(found, "match_id", "left").select(
        "match_id",
        "n_frames",
        F.coalesce("n_points", zero).alias("n_points"),
        F.coalesce("n_interpolated", zero).alias("n_interpolated"),
        F.bround(F.coalesce("n_points", zero) / F.col("n_frames"), 3).alias("coverage_fraction"),
    )


def ball_speed(points: DataFrame) -> DataFrame:
    """points with speed_ms from the point before, null where no time passed."""
    order = Window.partitionBy("match_id").orderBy("frame")
    step = {c: F.col(c) - F.lag(c).over(order) for c in ("t_s", "x_m", "y_m")}
    return points.withColumn("speed_ms", distance(step["x_m"], step["y_m"]) / F.nullif(step["t_s"], F.lit(0.0)))
