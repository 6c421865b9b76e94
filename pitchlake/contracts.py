"""Table contracts and their enforcement.

Within the engine numbers are double and unknown values null; the float types below are for
tables that leave it. match_id is added to every table, so one job runs many matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_SCHEMAS = {
    "detections": "match_id string, frame long, det_id long, cls string, conf float, x1 float, y1 float, x2 float, y2 float",
    "tracks_px": "match_id string, frame long, det_id long, cls string, conf float, x1 float, y1 float, x2 float, y2 float, track_id long",
    "tracks_m": "match_id string, frame long, t_s float, track_id long, team string, shirt short, player string, x_m float, y_m float, speed_ms float, conf float",
    "ball": "match_id string, frame long, t_s float, x_px float, y_px float, x_m float, y_m float, conf float, interpolated boolean",
    "events": "match_id string, period byte, t_s float, team string, player string, type_name string, start_x float, start_y float, end_x float, end_y float, result_name string, bodypart_name string",
}


def contract(name: str) -> StructType:
    return StructType.fromDDL(_SCHEMAS[name])


def enforce(df: DataFrame, name: str, strict: bool = False) -> DataFrame:
    """df with the contract's columns cast to its types.

    Missing columns are a ValueError that lists them sorted, found without running a job.
    Other columns stay where they are, unless strict, which also puts columns in order.
    """
    schema = contract(name)
    missing = sorted(set(schema.names) - set(df.columns))
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    types = {f.name: f.dataType for f in schema}
    if strict:
        return df.select(*(F.col(c).cast(t) for c, t in types.items()))
    return df.select(*(F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns))


def with_nulls(df: DataFrame, **columns: str) -> DataFrame:
    """df with typed null columns for those of the names that it lacks."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def empty(spark, name: str) -> DataFrame:
    return spark.createDataFrame([], contract(name))


def nan_to_null(df: DataFrame) -> DataFrame:
    """df whose float and double NaNs are null: sources call this at the boundary."""
    found = [f.name for f in df.schema if f.dataType.typeName() in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in found})
