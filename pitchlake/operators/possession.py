"""Who has the ball."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import distance

RADIUS_M, HOLD_FRAMES = 2.0, 3


def assign_possession(tracks: DataFrame, ball: DataFrame, radius_m: float = RADIUS_M, include_all: bool = False) -> DataFrame:
    """The nearest player to the ball in each frame that has both: match_id, frame,
    possessor_track_id, team, dist_m.

    Beyond radius_m the ball is loose: track and team are null. A distance of exactly
    radius_m is possession. Ties go to the smaller track_id; a frame without any known
    distance stays, with nulls. Only rows of the two teams count, unless include_all.
    """
    at = ball.select("match_id", "frame", F.col("x_m").alias("ball_x"), F.col("y_m").alias("ball_y"))
    players = tracks if include_all else tracks.where("team in ('home', 'away')")
    dist = distance(F.col("x_m") - F.col("ball_x"), F.col("y_m") - F.col("ball_y"))
    both = players.select("match_id", "frame", "track_id", "team", "x_m", "y_m").join(at, ["match_id", "frame"]).withColumn("dist_m", dist)
    nearest = F.min_by(F.struct("track_id", "team", "dist_m"), F.struct(F.col("dist_m").isNull(), "dist_m", "track_id", "team"))
    held = F.col("n.dist_m") <= radius_m
    return both.groupBy("match_id", "frame").agg(nearest.alias("n")).select(
        "match_id",
        "frame",
        F.when(held, F.col("n.track_id")).alias("possessor_track_id"),
        F.when(held, F.col("n.team")).alias("team"),
        F.col("n.dist_m").alias("dist_m"),
    )


def possession_share(possession: DataFrame) -> DataFrame:
    """Each team's share of the match's frames in which a team has the ball."""
    counts = possession.where("team is not null").groupBy("match_id", "team").agg(F.count(F.lit(1)).alias("n_frames"))
    return counts.withColumn("share", F.col("n_frames") / F.sum("n_frames").over(Window.partitionBy("match_id")))


def settled_possession(possession: DataFrame, hold_frames: int = HOLD_FRAMES) -> DataFrame:
    """possession with settled_track_id: the last possessor that held the ball for
    hold_frames rows in a row, so that a single frame doesn't turn it over."""
    order = Window.partitionBy("match_id").orderBy("frame")
    changed = ~F.col("possessor_track_id").eqNullSafe(F.lag("possessor_track_id").over(order))
    spell = F.sum(F.coalesce(changed, F.lit(True)).cast("int")).over(order)
    spells = possession.withColumn("spell", spell)
    length = F.count(F.lit(1)).over(Window.partitionBy("match_id", "spell"))
    firm = F.when(length >= hold_frames, F.struct("possessor_track_id", "team"))
    firm = F.when(F.col("possessor_track_id").isNotNull(), firm)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    last = spells.withColumn("firm", firm).withColumn("last", F.last("firm", ignorenulls=True).over(upto))
    return last.select(*possession.columns, F.col("last.possessor_track_id").alias("settled_track_id"), F.col("last.team").alias("settled_team"))


def possession_changes(settled: DataFrame) -> DataFrame:
    """Actions where the settled possessor changes: a pass within a team, else a turnover."""
    order = Window.partitionBy("match_id").orderBy("frame")
    had = {"from_track_id": F.lag("settled_track_id").over(order), "from_team": F.lag("settled_team").over(order)}
    moved = settled.withColumns(had).where("from_track_id is not null and settled_track_id is not null and from_track_id <> settled_track_id")
    kind = F.when(F.col("from_team") == F.col("settled_team"), "pass").otherwise("turnover")
    return moved.select("match_id", "frame", "from_track_id", F.col("settled_track_id").alias("to_track_id"), F.col("from_team").alias("team"), kind.alias("type_name"))
