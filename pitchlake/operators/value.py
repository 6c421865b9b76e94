"""The value of actions: how much likelier a goal becomes as the ball moves between zones."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import PITCH_LENGTH_M, PITCH_WIDTH_M

#: Zones along and across the pitch, and rounds of value iteration.
ZONES, ROUNDS = (12, 8), 50
MOVES = ("pass", "cross", "dribble", "corner_crossed", "throw_in", "goalkick")


def zone(x: str, y: str, zones: tuple[int, int] = ZONES) -> Column:
    """The zone of a point, numbered along the pitch first; points beyond the pitch are in the
    zone at its edge, unknown ones in none."""

    def part(c: str, size: float, n: int) -> Column:
        return F.least(F.greatest(F.floor(F.col(c) / (size / n)), F.lit(0)), F.lit(n - 1))

    number = part(y, PITCH_WIDTH_M, zones[1]) * zones[0] + part(x, PITCH_LENGTH_M, zones[0])
    return F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), number.cast("long"))


def zone_counts(actions: DataFrame, zones: tuple[int, int] = ZONES) -> DataFrame:
    """(zone, to_zone, n_shots, n_goals, n_moves, n_kept): what is done from each zone. Moves are
    counted by where they end, and kept where they succeed. Actions of other types or without
    a start are left out; moves without an end are not kept. At most zones squared rows."""
    known = actions.select("type_name", "result_name", zone("start_x", "start_y", zones).alias("zone"), zone("end_x", "end_y", zones).alias("to_zone"))
    shot, move = F.col("type_name") == "shot", F.col("type_name").isin(*MOVES)
    done = F.coalesce(F.col("result_name") == "success", F.lit(False))
    to_zone = F.when(move, F.col("to_zone")).alias("to_zone")
    counts = known.where((shot | move) & F.col("zone").isNotNull()).groupBy("zone", to_zone)
    kept = move & done & F.col("to_zone").isNotNull()
    return counts.agg(F.count_if(shot).alias("n_shots"), F.count_if(shot & done).alias("n_goals"), F.count_if(move).alias("n_moves"), F.count_if(kept).alias("n_kept"))


def zone_values(counts: DataFrame, zones: tuple[int, int] = ZONES, rounds: int = ROUNDS) -> np.ndarray:
    """The chance that a possession in each zone ends in a goal. Of what is done from a zone,
    a shot is worth the zone's share of goals, and a move the value of the zone where it is
    kept, 0 where it is lost:

        value = shots / all * goals / shots + sum over zones of kept moves / all * value there

    Values are 0 first, then as many rounds are made. All actions are counted by Spark; the
    driver has the counts of pairs of zones, which do not grow with the actions.
    """
    n = zones[0] * zones[1]
    goals, done, moved = np.zeros(n), np.zeros(n), np.zeros((n, n))
    for row in counts.collect():  # at most zones squared
        done[row.zone] += row.n_shots + row.n_moves
        goals[row.zone] += row.n_goals
        if row.n_kept:
            moved[row.zone, row.to_zone] += row.n_kept
    done = np.maximum(done, 1)
    value = np.zeros(n)
    for _ in range(rounds):
        value = goals / done + moved @ value / done
    return value


def value_table(spark, value: np.ndarray, zones: tuple[int, int] = ZONES) -> DataFrame:
    """(zone, zone_x, zone_y, value)."""
    return spark.createDataFrame([(i, i % zones[0], i // zones[0], float(v)) for i, v in enumerate(value)], "zone long, zone_x int, zone_y int, value double")


def value_actions(actions: DataFrame, values: DataFrame, zones: tuple[int, int] = ZONES) -> DataFrame:
    """actions with action_value: for a kept move the value of where it ends less that of
    where it starts; for a lost one, and for any shot, what is won or lost against the start's
    value (a goal is worth 1). Null for other actions and without a start."""
    start, end = (values.select(F.col("zone").alias(f"__{e}"), F.col("value").alias(f"__{e}_value")) for e in ("start", "end"))
    placed = actions.withColumns({"__start": zone("start_x", "start_y", zones), "__end": zone("end_x", "end_y", zones)})
    both = placed.join(F.broadcast(start), "__start", "left").join(F.broadcast(end), "__end", "left")  # a row for each zone
    done = F.coalesce(F.col("result_name") == "success", F.lit(False))
    after = F.when(F.col("type_name") == "shot", done.cast("double")).when(F.col("type_name").isin(*MOVES), F.when(done, F.coalesce("__end_value", F.lit(0.0))).otherwise(0.0))
    return both.withColumn("action_value", after - F.col("__start_value")).drop("__start", "__end", "__start_value", "__end_value")
