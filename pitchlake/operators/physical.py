"""Kinematics of tracks and physical totals of players."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import with_nulls
from ..functions.geometry import distance

SPRINT_MS = 7.0
TRACK = ("match_id", "track_id")


def _order(df: DataFrame) -> list[str]:
    return ["frame", *(["det_id"] if "det_id" in df.columns else [])]


def add_kinematics(tracks: DataFrame, smooth_window: int = 5) -> DataFrame:
    """tracks with smoothed x_m and y_m, speed_ms and accel_ms2.

    Positions are centred means over smooth_window rows of the track (fewer at its ends),
    unknown ones left out; an even window reaches one row further back. Speed and
    acceleration are differences to the row before, null where no time has passed. Rows
    without a track (track_id below 0) are no trajectory: they keep their positions, have
    no kinematics, and are not shuffled.
    """
    order = Window.partitionBy(*TRACK).orderBy(*_order(tracks))
    around = order.rowsBetween(-(smooth_window // 2), (smooth_window - 1) // 2)
    tracked = tracks.where("track_id >= 0")
    tracked = tracked.withColumns({c: F.avg(c).over(around) for c in ("x_m", "y_m")})
    step = {c: F.col(c) - F.lag(c).over(order) for c in ("t_s", "x_m", "y_m")}
    dt = F.nullif(step["t_s"], F.lit(0.0))
    tracked = tracked.withColumns({"__dt": dt, "speed_ms": distance(step["x_m"], step["y_m"]) / dt})
    tracked = tracked.withColumn("accel_ms2", (F.col("speed_ms") - F.lag("speed_ms").over(order)) / F.col("__dt")).drop("__dt")
    rest = with_nulls(tracks.where("track_id < 0 or track_id is null").drop("speed_ms", "accel_ms2"), speed_ms="double", accel_ms2="double")
    return tracked.unionByName(rest)


def summarise_player(tracks: DataFrame) -> DataFrame:
    """Totals for each match, team, player and track: minutes, distance_m, top_speed_ms and
    sprints (frames above SPRINT_MS). Nulls are groups like others, so unnamed tracks stay
    apart. Rows of unknown speed are left out before time steps are taken."""
    known = tracks.where("speed_ms is not null")
    order = Window.partitionBy(*TRACK).orderBy(*_order(tracks))
    dt = F.coalesce(F.col("t_s") - F.lag("t_s").over(order), F.lit(0.0))
    steps = known.withColumn("step_m", F.col("speed_ms") * dt)
    return steps.groupBy("match_id", "team", "player", "track_id").agg(
        ((F.max("t_s") - F.min("t_s")) / 60).alias("minutes"),
        F.sum("step_m").alias("distance_m"),
        F.max("speed_ms").alias("top_speed_ms"),
        F.count_if(F.col("speed_ms") > SPRINT_MS).alias("sprints"),
    )
