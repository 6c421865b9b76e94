"""Who a track is: votes of shirt numbers, and the squad."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_VOTES, MIN_SHARE = 5, 0.5


def majority_vote(readings: DataFrame, min_votes: int = MIN_VOTES, min_share: float = MIN_SHARE) -> DataFrame:
    """Each track's shirt, from readings (match_id, track_id, seq, number).

    Null numbers are no readings. The most frequent number wins, ties go to the one read
    first; null if there are fewer than min_votes readings or its share is below min_share.
    """
    track = ["match_id", "track_id"]
    counts = readings.where("number is not null").groupBy(*track, "number").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    best = F.max_by("number", F.struct("n", -F.col("first"))).alias("number")
    votes = counts.groupBy(*track).agg(F.sum("n").alias("n_votes"), F.max("n").alias("n_best"), best)
    sure = (F.col("n_votes") >= min_votes) & (F.col("n_best") / F.col("n_votes") >= min_share)
    known = readings.select(*track).distinct().join(votes, track, "left")
    return known.select(*track, F.coalesce("n_votes", F.lit(0).cast("long")).alias("n_votes"), F.when(sure, F.col("number")).alias("shirt"))


def name_players(tracks: DataFrame, squad: DataFrame) -> DataFrame:
    """tracks (with team and shirt) with player, by the squad (side, shirt, name, and
    match_id if it is of several matches). Unknown teams or shirts have no player. Of several
    names of one shirt the greatest counts, so that no row is multiplied; config.squad has
    one name for each shirt already."""
    on = [c for c in ("match_id",) if c in squad.columns and c in tracks.columns] + ["team", "shirt"]
    names = squad.withColumnsRenamed({"side": "team", "name": "player"}).groupBy(*on).agg(F.max("player").alias("player"))
    return tracks.drop("player").join(names, on, "left")


def abstain(tracks: DataFrame) -> DataFrame:
    """tracks without identities: shirt and player are null in every row."""
    return tracks.withColumns({"shirt": F.lit(None).cast("short"), "player": F.lit(None).cast("string")})


def identify(tracks: DataFrame, readings: DataFrame | None = None, squad: DataFrame | None = None, min_votes: int = MIN_VOTES) -> DataFrame:
    """tracks with shirt and player from readings and the squad; without readings, none."""
    if readings is None:
        return abstain(tracks)
    shirts = majority_vote(readings, min_votes).select("match_id", "track_id", F.col("shirt").cast("short").alias("shirt"))
    with_shirts = tracks.drop("shirt", "player").join(shirts, ["match_id", "track_id"], "left")
    return name_players(with_shirts, squad) if squad is not None else with_shirts.withColumn("player", F.lit(None).cast("string"))


def identity_coverage(tracks: DataFrame) -> DataFrame:
    """For each match the share of rows, but the ball's, with a player, to 3 digits."""
    others = F.coalesce(F.col("cls") != "ball", F.lit(True))
    share = F.coalesce(F.avg(F.when(others, F.col("player").isNotNull().cast("int"))), F.lit(0.0))
    return tracks.groupBy("match_id").agg(F.bround(share, 3).alias("identity_coverage"))


def vote_counts(readings: DataFrame) -> DataFrame:
    """How often each number was read on each track, with its rank on the track."""
    counts = readings.where("number is not null").groupBy("match_id", "track_id", "number").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    order = Window.partitionBy("match_id", "track_id").orderBy(F.desc("n"), "first")
    return counts.withColumn("rank", F.row_number().over(order))
