"""Tracking: boxes of consecutive frames joined to tracks, match by match."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRACKABLE = ("player", "goalkeeper", "referee")
ACTIVATION, LOST_FRAMES, MATCHING = 0.25, 60, 0.85


def check_backend(name: str) -> None:
    if name == "botsort":
        raise NotImplementedError("botsort is not available; use bytetrack")
    if name != "bytetrack":
        raise ValueError(f"unknown tracker backend: {name!r}")


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of each box of a with each of b."""
    low, high = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, 2:], b[None, :, 2:])
    both = np.prod(np.clip(high - low, 0, None), axis=2)
    area = [np.prod(np.clip(x[:, 2:] - x[:, :2], 0, None), axis=1) for x in (a, b)]
    return both / np.maximum(area[0][:, None] + area[1][None] - both, 1e-9)


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """The pairing of rows and columns of least total cost (shortest augmenting paths)."""
    if cost.shape[0] > cost.shape[1]:
        return [(i, j) for j, i in assignment(cost.T)]
    n, m = cost.shape
    row_price, column_price, row_of = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        row_of[0], j, least, came, done = i, 0, np.full(m + 1, np.inf), np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=bool)
        while row_of[j]:
            done[j] = True
            free = np.flatnonzero(~done[1:]) + 1
            now = cost[row_of[j] - 1, free - 1] - row_price[row_of[j]] - column_price[free]
            better = now < least[free]
            least[free[better]], came[free[better]] = now[better], j
            nearest = free[np.argmin(least[free])]
            delta = least[nearest]
            row_price[row_of[done]] += delta
            column_price[done] -= delta
            least[~done] -= delta
            j = nearest
        while j:
            row_of[j] = row_of[came[j]]
            j = came[j]
    return [(int(row_of[j]) - 1, j - 1) for j in range(1, m + 1) if row_of[j]]


def matches(score: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs of rows and columns that score `least` or more, of greatest total score. Only
    rows and columns that compete for each other are solved; most pairs stand alone."""
    can = score >= least
    sure = can & (can.sum(axis=1, keepdims=True) == 1) & (can.sum(axis=0, keepdims=True) == 1)
    found = list(zip(*map(np.ndarray.tolist, np.nonzero(sure)), strict=True))
    rows, columns = np.flatnonzero((can & ~sure).any(axis=1)), np.flatnonzero((can & ~sure).any(axis=0))
    if len(rows):
        own = np.where(can, score, 0.0)[np.ix_(rows, columns)]
        found += [(int(rows[r]), int(columns[c])) for r, c in assignment(1 - own) if own[r, c] >= least]
    return found


def lost_frames_at(fps: float | Column, buffer: int = LOST_FRAMES) -> int | Column:
    """Places of the grid that a track is kept unseen, when `buffer` is counted at 30 frames a
    second and the grid has fps, the recording's rate over its stride."""
    if isinstance(fps, Column):
        return F.greatest(F.lit(1), F.floor(F.greatest(F.lit(1.0), F.bround(fps)) / 30 * buffer).cast("int"))
    return max(1, int(max(1, round(fps)) / 30 * buffer))


# A box's position and speed are known to these parts of its height, its aspect
# and that's change to these numbers; at its first sight the errors are so many times larger.
POSITION_PART, SPEED_PART, ASPECT_ERROR, ASPECT_CHANGE, ASPECT_SEEN = 1 / 20, 1 / 160, 1e-2, 1e-5, 1e-1
FIRST_POSITION, FIRST_SPEED = 2, 10


def _shape(boxes: np.ndarray) -> np.ndarray:
    """Centre, aspect (width over height) and height of boxes of corners."""
    w, h = boxes[:, 2] - boxes[:, 0], boxes[:, 3] - boxes[:, 1]
    return np.column_stack([boxes[:, 0] + w / 2, boxes[:, 1] + h / 2, w / np.where(h > 0, h, 1), h])


def _corners(shape: np.ndarray) -> np.ndarray:
    x, y, aspect, h = shape.T
    w = aspect * h
    return np.column_stack([x - w / 2, y - h / 2, x + w / 2, y + h / 2])


def _variance(h: np.ndarray, part: float, aspect: float) -> np.ndarray:
    """Squared errors of centre, aspect and height of boxes of height h."""
    e = (part * h) ** 2
    return np.column_stack([e, e, np.full(len(h), aspect**2), e])


class _Tracks:
    """The live tracks, side by side. Each has a Kalman filter of constant velocity over its
    box's centre, aspect and height; these do not mix, so each has a position, a speed and
    their 2 x 2 covariance."""

    def __init__(self):
        self.ids, self.seen = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.at, self.speed, self.p, self.ps, self.s = (np.empty((0, 4)) for _ in range(5))

    def keep(self, some: np.ndarray) -> None:
        for name, value in vars(self).items():
            setattr(self, name, value[some])

    def begin(self, ids: np.ndarray, boxes: np.ndarray, place: int) -> None:
        at = _shape(boxes)
        first = {
            "ids": ids,
            "seen": np.full(len(ids), place),
            "at": at,
            "speed": np.zeros_like(at),
            "p": _variance(at[:, 3], FIRST_POSITION * POSITION_PART, ASPECT_ERROR),
            "ps": np.zeros_like(at),
            "s": _variance(at[:, 3], FIRST_SPEED * SPEED_PART, ASPECT_CHANGE),
        }
        for name, value in first.items():
            setattr(self, name, np.concatenate([getattr(self, name), value]))

    def predict(self, place: int) -> None:
        """One place on. The height of a track that was not seen at the last place stays."""
        h = self.at[:, 3].copy()
        self.speed[self.seen < place - 1, 3] = 0
        self.at = self.at + self.speed
        self.p = self.p + 2 * self.ps + self.s + _variance(h, POSITION_PART, ASPECT_ERROR)
        self.ps = self.ps + self.s
        self.s = self.s + _variance(h, SPEED_PART, ASPECT_CHANGE)

    def update(self, some: np.ndarray, boxes: np.ndarray, place: int) -> None:
        noise = _variance(self.at[some, 3], POSITION_PART, ASPECT_SEEN)
        p, ps = self.p[some], self.ps[some]
        gain, pull = p / (p + noise), ps / (p + noise)
        surprise = _shape(boxes) - self.at[some]
        self.at[some] += gain * surprise
        self.speed[some] += pull * surprise
        self.p[some], self.ps[some], self.s[some] = (1 - gain) * p, (1 - gain) * ps, self.s[some] - pull * ps
        self.seen[some] = place


def associate(places: np.ndarray, conf: np.ndarray, boxes: np.ndarray, activation: float, lost_frames: int, matching: float) -> np.ndarray:
    """Track ids, from 1, of one match's trackable boxes, which come by place; -1 for those that
    stay alone and are too faint to begin a track.

    Two passes a place (as ByteTrack, arXiv:2110.06864): boxes of at least `activation`
    confidence meet all tracks seen within lost_frames places, what is left of them meets
    fainter boxes, and confident boxes that stay alone begin tracks, in their order. Tracks
    are predicted at every place, those without boxes too, by their Kalman filters.
    """
    out = np.full(len(places), -1, dtype=np.int64)
    live, n, now = _Tracks(), 0, None
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]])) if len(places) else []
    for begin, end in zip(first, [*first[1:], len(places)], strict=True):
        place = int(places[begin])
        if len(live.ids):
            dead = place - live.seen > lost_frames + 1
            if dead.any():
                live.keep(~dead)
            for step in range(now + 1, place + 1) if len(live.ids) else ():
                live.predict(step)
        now = place
        at = np.arange(begin, end)
        strong = conf[at] >= activation
        free = np.arange(len(live.ids))
        for some, least in ((at[strong], 1 - matching), (at[~strong], 0.5)):
            if len(some) and len(free):
                pairs = matches(overlaps(_corners(live.at[free]), boxes[some]), least)
                if pairs:
                    r, c = np.array(pairs).T
                    live.update(free[r], boxes[some[c]], place)
                    out[some[c]] = live.ids[free[r]]
                    free = np.delete(free, r)
        alone = at[strong & (out[at] < 0)]
        if len(alone):
            out[alone] = np.arange(n + 1, n + 1 + len(alone))
            live.begin(out[alone], boxes[alone], place)
            n += len(alone)
    return out


def track(
    detections: DataFrame,
    grid: DataFrame | None = None,
    classes: tuple[str, ...] = TRACKABLE,
    activation: float = ACTIVATION,
    lost_frames: int | Column = LOST_FRAMES,
    matching: float = MATCHING,
) -> DataFrame:
    """detections with track_id; -1 for the ball, other classes and boxes without a track.

    Time runs on the grid (match_id, pos, frame), so frames without boxes count as time
    lost; without a grid it is the frames that have boxes. lost_frames is a number, or an
    expression over detections that is the same in all of a match.

    Where no trackable box is seen for longer than tracks live, a match is cut: what follows
    is an island that is associated apart, and its ids go on from those begun before it, by
    a prefix sum. Ids are those of one pass over the match. Within an island boxes are
    associated in the order of frames.
    """
    found = detections.drop("track_id").withColumn("__lost", lost_frames if isinstance(lost_frames, Column) else F.lit(int(lost_frames)))
    if grid is None:
        place = F.dense_rank().over(Window.partitionBy("match_id").orderBy("frame")).cast("long")
        placed = found.withColumn("place", place)
    else:
        placed = found.join(grid.select("match_id", "frame", F.col("pos").alias("place")), ["match_id", "frame"])
    few = placed.where(F.col("cls").isin(*classes)).select("match_id", "frame", "det_id", "place", "conf", "x1", "y1", "x2", "y2", F.col("__lost").cast("int").alias("lost"))
    order = Window.partitionBy("match_id").orderBy("place")
    cut = F.col("place") - F.lag("place").over(order) > F.col("lost") + 1
    few = few.withColumn("island", F.sum(F.coalesce(cut, F.lit(False)).cast("int")).over(order))

    def ids(island: pd.DataFrame) -> pd.DataFrame:
        rows = island.sort_values(["place", "det_id"], kind="stable").reset_index(drop=True)
        boxes = rows[["x1", "y1", "x2", "y2"]].to_numpy(dtype=np.float64)
        own = associate(rows["place"].to_numpy(), rows["conf"].to_numpy(dtype=np.float64), boxes, activation, int(rows["lost"].iloc[0]), matching)
        begins = ~pd.Series(own).duplicated() & (own >= 0)
        return rows.assign(own=own, begins=begins.astype("int32"))[["match_id", "frame", "det_id", "island", "own", "begins"]]

    known = few.groupBy("match_id", "island").applyInPandas(ids, "match_id string, frame long, det_id long, island long, own long, begins int")
    before = F.coalesce(F.sum("begins").over(Window.partitionBy("match_id").orderBy("island").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = known.select("match_id", "frame", "det_id", F.when(F.col("own") >= 0, F.col("own") + before).alias("track_id"))
    joined = detections.drop("track_id").join(known, ["match_id", "frame", "det_id"], "left")
    return joined.withColumn("track_id", F.coalesce("track_id", F.lit(-1).cast("long")))


def tracking_stats(tracks: DataFrame, classes: tuple[str, ...] = TRACKABLE) -> DataFrame:
    """For each match n_tracks, tracked_fraction (of trackable rows, to 3 digits) and
    mean_track_len (to 1 digit); 0 where there is nothing to divide by."""
    can, has = F.col("cls").isin(*classes), F.col("track_id") >= 0
    counts = tracks.groupBy("match_id").agg(
        F.count_if(can).alias("n_trackable"), F.count_if(can & has).alias("n_tracked"), F.countDistinct(F.when(has, F.col("track_id"))).alias("n_tracks")
    )
    zero = F.lit(0.0)
    return counts.select(
        "match_id",
        "n_tracks",
        F.coalesce(F.bround(F.col("n_tracked") / F.nullif("n_trackable", F.lit(0)), 3), zero).alias("tracked_fraction"),
        F.coalesce(F.bround(F.col("n_tracked") / F.nullif("n_tracks", F.lit(0)), 1), zero).alias("mean_track_len"),
    )
