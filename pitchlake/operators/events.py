"""Action tables in the common vocabulary of on-ball actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contracts import empty, enforce
from ..functions.geometry import GOAL_WIDTH_M, GOAL_Y_M, PITCH_LENGTH_M, rate, seconds
from .asof import as_of
from .possession import possession_changes

#: Metres a second that make a spike; seconds within which a change of possession belongs to it.
SPIKE_MS, SPIKE_S = 18.0, 3.0
#: A spike is a shot if its line meets a goal line within this distance, so near the posts.
SHOT_RANGE_M, SHOT_MARGIN_M = 40.0, 2.0

# Action types, from this library's names to the common vocabulary.
ACTION_TYPES = {
    "pass": "pass",
    "cross": "cross",
    "shot": "shot",
    "dribble": "dribble",
    "tackle": "tackle",
    "interception": "interception",
    "clearance": "clearance",
    "foul": "foul",
    "corner": "corner_crossed",
    "throw_in": "throw_in",
    "goalkick": "goalkick",
    "keeper_save": "keeper_save",
}


def map_types(df: DataFrame) -> DataFrame:
    """df with type_name in the common vocabulary; unknown names stay."""
    known = F.create_map(*(F.lit(x) for pair in ACTION_TYPES.items() for x in pair))
    return df.withColumn("type_name", F.coalesce(F.try_element_at(known, F.col("type_name")), F.col("type_name")))


def to_actions(events: DataFrame) -> DataFrame:
    """An events table, enforced and with types in the common vocabulary."""
    return map_types(enforce(events, "events"))


def no_events(spark: SparkSession) -> DataFrame:
    """What the events stage gives while it has no source: the table without rows."""
    return empty(spark, "events")


def from_tags(tags: DataFrame, match_id: str | Column) -> DataFrame:
    """The events table of a tagging sheet (see sources.files.TAGGING), of one match or of
    those that a column names: clock_mmss becomes seconds, the shirt stands for the player."""
    part = F.split("clock_mmss", ":")
    t_s = part[0].cast("double") * 60 + part[1].cast("double")
    rows = tags.withColumns({"match_id": match_id if isinstance(match_id, Column) else F.lit(match_id), "t_s": t_s, "player": F.col("shirt").cast("string")})
    return enforce(rows, "events", strict=True)


def ball_spikes(ball: DataFrame, least_ms: float = SPIKE_MS) -> DataFrame:
    """Frames of a ball table with speed_ms where the ball passes least_ms from below: shots
    or clearances."""
    order = Window.partitionBy("match_id").orderBy("frame")
    slow = F.coalesce(F.lag("speed_ms").over(order) < least_ms, F.lit(True))
    return ball.withColumn("slow", slow).where((F.col("speed_ms") >= least_ms) & F.col("slow")).select("match_id", "frame", "t_s", "speed_ms", F.lit("shot_or_clearance").alias("type_name"))


def _kind_of_spike() -> Column:
    """shot or clearance, by where the line from start through spike (both x_m, y_m) meets the
    goal line ahead."""
    dx, dy = F.col("spike.x_m") - F.col("start.x_m"), F.col("spike.y_m") - F.col("start.y_m")
    ahead = F.when(dx > 0, PITCH_LENGTH_M - F.col("start.x_m")).when(dx < 0, -F.col("start.x_m"))
    y = F.col("start.y_m") + ahead * dy / F.nullif(dx, F.lit(0.0))
    goal = (F.abs(ahead) <= SHOT_RANGE_M) & (F.abs(y - GOAL_Y_M) <= GOAL_WIDTH_M / 2 + SHOT_MARGIN_M)
    return F.when(F.coalesce(goal, F.lit(False)), "shot").otherwise("clearance")


def action_stream(settled: DataFrame, ball: DataFrame, fps: float | None = 25.0, least_ms: float = SPIKE_MS, within_s: float = SPIKE_S, cameras: DataFrame | None = None) -> DataFrame:
    """Actions of settled possession (see possession.settled_possession) and a ball table with
    speed_ms, both of one row a frame: match_id, frame, t_s, track_id, team, type_name,
    result_name, start_x, start_y, end_x, end_y.

    A change of the settled possessor is a pass, a success, or, between teams, a turnover, a
    fail. The first spike of the ball's speed since the change before is a shot or a clearance
    of who is in possession, unless the next change, within within_s, is a pass: then the
    spike is the pass's own. If that change is a turnover, it is the spike's end and no
    action of its own, and the spike fails; else a spike's result is unknown, and it ends where
    it is seen. Spikes before anybody is in possession have no track and team.

    Positions are the ball's: at the start the last one known up to the frame that the
    possessor is last seen with (a spike: the frame before it), at the end the first one known
    from the frame on where the action ends. Unknown ones are null. cameras (match_id, fps)
    has the rates of matches that differ from fps.
    """

    def in_seconds(rows: DataFrame, frames: Column, name: str) -> DataFrame:
        if cameras is None:
            return rows.withColumn(name, seconds(frames, fps))
        own = cameras.select("match_id", F.nullif(F.col("fps").cast("double"), F.lit(0.0)).alias("__fps"))
        return rows.join(own, "match_id", "left").withColumn(name, seconds(frames, F.coalesce("__fps", rate(fps)))).drop("__fps")

    order = Window.partitionBy("match_id").orderBy("frame")
    before = settled.select("match_id", "frame", F.lag("frame").over(order).alias("from_frame"))
    changes = possession_changes(settled).join(before, ["match_id", "frame"])
    changes = changes.select("match_id", "frame", "from_frame", F.col("from_track_id").alias("track_id"), "team", "type_name")
    holders = settled.where("settled_track_id is not null").select("match_id", "frame", F.col("settled_track_id").alias("track_id"), F.col("settled_team").alias("team"))
    spikes = ball_spikes(ball, least_ms).select("match_id", "frame")
    spikes = as_of(spikes, holders, F.col("frame") - 1, "frame", "holder", ["track_id", "team"], unique=True)
    spikes = as_of(spikes, changes.withColumn("at", F.col("frame")), F.col("frame"), "frame", "next", ["at", "type_name"], after=True, unique=True)
    first = F.row_number().over(Window.partitionBy("match_id", "next.at").orderBy("frame"))
    spikes = in_seconds(spikes.withColumn("n", first), F.col("next.at") - F.col("frame"), "wait")
    spikes = spikes.withColumn("next", F.when(F.col("wait") <= within_s, F.col("next"))).where("n = 1 and (next is null or next.type_name <> 'pass')")
    ended = spikes.where("next is not null").select("match_id", F.col("next.at").alias("frame"))
    kept = changes.join(ended, ["match_id", "frame"], "left_anti")
    done = F.when(F.col("type_name") == "pass", "success").otherwise("fail")
    actions = kept.select("match_id", "frame", "track_id", "team", "type_name", done.alias("result_name"), "from_frame", F.col("frame").alias("to_frame"))
    missed = F.when(F.col("next").isNotNull(), "fail")
    shots = spikes.select(
        "match_id", "frame", "holder.track_id", "holder.team", F.lit(None).cast("string").alias("type_name"), missed.alias("result_name"), (F.col("frame") - 1).alias("from_frame"), F.coalesce("next.at", "frame").alias("to_frame")
    )
    both = actions.unionByName(shots)
    known = ball.where("x_m is not null and y_m is not null")
    both = as_of(both, known, F.col("from_frame"), "frame", "start", ["x_m", "y_m"], unique=True)
    both = as_of(both, known, F.col("frame"), "frame", "spike", ["x_m", "y_m"], unique=True)
    both = as_of(both, known, F.col("to_frame"), "frame", "end", ["x_m", "y_m"], after=True, unique=True)
    both = in_seconds(both, F.col("frame"), "t_s")
    places = {f"{end}_{c}": F.col(f"{end}.{c}_m") for end in ("start", "end") for c in ("x", "y")}
    return both.select(
        "match_id",
        "frame",
        "t_s",
        "track_id",
        "team",
        F.coalesce("type_name", _kind_of_spike()).alias("type_name"),
        "result_name",
        *(v.alias(k) for k, v in places.items()),
    )


def from_tracking(tracks: DataFrame, settled: DataFrame, ball: DataFrame, fps: float | None = 25.0, cameras: DataFrame | None = None) -> DataFrame:
    """The events table of action_stream, with players where tracks (match_id, track_id, player)
    name them. Period and body part are not known from tracking. cameras (match_id, fps) has
    the rates of matches that differ from fps."""
    names = tracks.where("track_id >= 0").groupBy("match_id", "track_id").agg(F.max("player").alias("player"))
    actions = action_stream(settled, ball, fps, cameras=cameras).join(names, ["match_id", "track_id"], "left")
    unknown = {"period": F.lit(None).cast("byte"), "bodypart_name": F.lit(None).cast("string")}
    return map_types(enforce(actions.withColumns(unknown), "events", strict=True))
