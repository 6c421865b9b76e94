"""The ball's speed gate over a stream of detections, with state for each match."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.geometry import box_centre, rate
from ..operators.ball import REACQUIRE_S

_OUT = "match_id string, frame long, x_px double, y_px double, conf double, accepted boolean"
#: The candidate that waits for its frame's end, and the last accepted one; nulls where there is none.
_STATE = "frame long, det_id long, conf double, x double, y double, last_frame long, last_x double, last_y double"


def _gate(last: tuple | None, frame: int, x: float, y: float, fps: float, limit: float, reacquire_s: float) -> bool:
    if last is None:
        return True
    dt = (frame - last[0]) / fps
    way = ((x - last[1]) ** 2 + (y - last[2]) ** 2) ** 0.5
    return dt > 0 and (dt > reacquire_s or way / dt <= limit)


def live_speed_gate(detections: DataFrame, fps: float, max_px_per_s: float, reacquire_s: float = REACQUIRE_S, late: str = "2 seconds", start: str = "1970-01-01") -> DataFrame:
    """The stream's balls as operators.ball.speed_gate judges the whole table's: match_id, frame,
    x_px, y_px, conf, accepted.

    Detections of a match come by frame, cut into micro-batches anywhere, within a frame too.
    So the surest ball of a frame (ties to the smaller det_id) waits until a later frame's
    comes; or until the watermark, `late` behind the newest frame of all matches, is
    reacquire_s past it. Then the match's state is dropped: whatever comes next is accepted,
    as the gate has it. Balls of frames that have been judged already are too late, and left
    out. A frame's time is start plus its number over fps.
    """
    second = rate(fps)
    x, y = box_centre()
    at = F.timestamp_seconds(F.col("frame") / second + F.unix_timestamp(F.lit(start).cast("timestamp")))
    balls = detections.where("cls = 'ball'").select("match_id", "frame", "det_id", F.col("conf").cast("double").alias("conf"), x.cast("double").alias("x"), y.cast("double").alias("y"), at.alias("ts"))

    def judge(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = last = None
        if state.exists:
            old = state.get
            held = old[:5] if old[0] is not None else None
            last = old[5:] if old[5] is not None else None
        out = []

        def settle() -> None:
            nonlocal held, last
            frame, _, conf, hx, hy = held
            ok = _gate(last, frame, hx, hy, fps or 25.0, max_px_per_s, reacquire_s)
            out.append((key[0], frame, hx, hy, conf, ok))
            if ok:
                last = (frame, hx, hy)
            held = None

        newest = None
        if state.hasTimedOut:
            if held is not None:
                settle()
            state.remove()
        else:
            judged = held[0] if held is not None else last[0] if last is not None else None
            for part in parts:
                rows = part.sort_values(["frame", "det_id"], kind="stable")
                for frame, det, conf, px, py in zip(*(rows[c].tolist() for c in ("frame", "det_id", "conf", "x", "y")), strict=True):
                    if judged is not None and frame < judged:
                        continue
                    if held is not None and frame == held[0]:
                        if (conf, -det) > (held[2], -held[1]):
                            held = (frame, det, conf, px, py)
                        continue
                    if held is not None:
                        settle()
                    held, judged = (frame, det, conf, px, py), frame
                newest = part["ts"].max() if newest is None else max(newest, part["ts"].max())
            state.update((*(held or (None,) * 5), *(last or (None,) * 3)))
            wait = int(1000 * reacquire_s) + 1
            state.setTimeoutTimestamp(max(int(newest.timestamp() * 1000), state.getCurrentWatermarkMs()) + wait)
        yield pd.DataFrame(out, columns=["match_id", "frame", "x_px", "y_px", "conf", "accepted"])

    timed = balls.withWatermark("ts", late).groupBy("match_id")
    return timed.applyInPandasWithState(judge, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
