"""Teams of tracks by the colours of their shirts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import chroma_of_hex, distance

SAMPLE_STRIDE, MIN_CROPS, MIN_BOX_H = 5, 3, 16.0
OUTLIER_DIST, SPECIAL_DIST = 25.0, 40.0
#: Points of which all pairs start a run of two-means; rounds of a run, at most.
STARTS, ROUNDS = 6, 100
#: Distances that differ by less are equal: two points are as far from their middle.
TIE = 1e-6
# Grass in 8-bit HSV (hue of 0 to 179), the torso's part of a box, least sizes.
GRASS_HUE, GRASS_SATURATION = (35, 90), 60
TORSO_Y, TORSO_X = (0.15, 0.50), (0.25, 0.75)
LEAST_BOX_H, LEAST_BOX_W, LEAST_PIXELS = 8, 4, 12


def check_method(method: str) -> None:
    if method == "siglip_umap_kmeans":
        raise NotImplementedError("siglip_umap_kmeans needs an image encoder; use kit_colour")
    if method != "kit_colour":
        raise ValueError(f"unknown team method: {method!r}")


def sampled_boxes(tracks: DataFrame, sample_stride: int = SAMPLE_STRIDE, min_box_h: float = MIN_BOX_H) -> DataFrame:
    """The boxes of which colours are taken: tracked, not the ball, tall enough, every
    sample_stride-th frame by its number."""
    wanted = (F.col("track_id") >= 0) & (F.col("cls") != "ball") & (F.col("y2") - F.col("y1") >= min_box_h) & (F.col("frame") % sample_stride == 0)
    return tracks.where(wanted)


def lab_chroma(bgr: np.ndarray) -> np.ndarray:
    """a and b of 8-bit BGR pixels in CIE Lab, offset by 128 and rounded."""
    c = bgr[..., ::-1].astype(np.float64) / 255
    c = np.where(c > 0.04045, ((c + 0.055) / 1.055) ** 2.4, c / 12.92)
    # sRGB to XYZ, relative to the D65 white.
    xyz = c @ np.array([[0.412453, 0.212671, 0.019334], [0.357580, 0.715160, 0.119193], [0.180423, 0.072169, 0.950227]]) / (0.950456, 1.0, 1.088754)
    f = np.where(xyz > 0.008856, np.cbrt(xyz), 7.787 * xyz + 16 / 116)
    return np.round(np.stack([500 * (f[..., 0] - f[..., 1]), 200 * (f[..., 1] - f[..., 2])], axis=-1) + 128)


def is_grass(bgr: np.ndarray) -> np.ndarray:
    """Where 8-bit BGR pixels have the hue and saturation of grass."""
    b, g, r = (bgr[..., i].astype(np.float64) for i in range(3))
    top, low = bgr.max(axis=-1).astype(np.float64), bgr.min(axis=-1).astype(np.float64)
    span = np.where(top > low, top - low, 1.0)
    hue = np.select([top == r, top == g], [(g - b) / span * 60, 120 + (b - r) / span * 60], 240 + (r - g) / span * 60)
    hue = np.round(np.where(top > low, hue % 360, 0.0) / 2) % 180
    saturation = np.round(255 * (top - low) / np.maximum(top, 1))
    return (hue >= GRASS_HUE[0]) & (hue <= GRASS_HUE[1]) & (saturation >= GRASS_SATURATION)


def torso_chroma(image: np.ndarray, box: tuple[float, float, float, float]) -> tuple[float, float] | None:
    """Median chroma of a box's torso without grass; None if too little of it is left."""
    x1, y1, x2, y2 = box
    w, h = x2 - x1, y2 - y1
    if h < LEAST_BOX_H or w < LEAST_BOX_W:
        return None
    rows = slice(max(0, int(y1 + TORSO_Y[0] * h)), max(0, int(y1 + TORSO_Y[1] * h)))
    columns = slice(max(0, int(x1 + TORSO_X[0] * w)), max(0, int(x1 + TORSO_X[1] * w)))
    crop = image[rows, columns].reshape(-1, image.shape[-1])
    kit = crop[~is_grass(crop)] if len(crop) else crop
    if len(kit) < LEAST_PIXELS:
        return None
    a, b = np.median(lab_chroma(kit), axis=0)
    return float(a), float(b)


def box_chroma(frames: DataFrame, boxes: DataFrame) -> DataFrame:
    """(match_id, track_id, frame, a, b) of boxes, from frames (match_id, frame, height,
    width, nChannels, data: BGR bytes). Only frames that have boxes are read further."""
    key = ["match_id", "frame"]
    lists = boxes.groupBy(*key).agg(F.collect_list(F.struct("track_id", "x1", "y1", "x2", "y2")).alias("boxes"))  # of one image

    def crops(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for row in part.itertuples():
                image = np.frombuffer(row.data, dtype=np.uint8).reshape(row.height, row.width, row.nChannels)
                for box in row.boxes:
                    ab = torso_chroma(image, (box["x1"], box["y1"], box["x2"], box["y2"]))
                    if ab:
                        out.append((row.match_id, box["track_id"], row.frame, *ab))
            yield pd.DataFrame(out, columns=["match_id", "track_id", "frame", "a", "b"])

    return frames.join(lists, key).mapInPandas(crops, "match_id string, track_id long, frame long, a double, b double")


def track_chroma(samples: DataFrame, min_crops: int = MIN_CROPS) -> DataFrame:
    """Each track's median chroma, of at least min_crops samples."""
    n = F.count(F.lit(1))
    return samples.groupBy("match_id", "track_id").agg(F.median("a").alias("a"), F.median("b").alias("b"), n.alias("n_crops")).where(F.col("n_crops") >= min_crops)


def _starts(points: np.ndarray) -> np.ndarray:
    """Pairs of places that start a run of two-means: all pairs of a few points that lie far
    from each other. The first is the one farthest from the mean, each next one the farthest
    from those taken; ties go to the first place."""
    apart = [int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmax())]
    near = np.full(len(points), np.inf)
    while len(apart) < min(STARTS, len(points)):
        near = np.minimum(near, ((points - points[apart[-1]]) ** 2).sum(axis=1))
        apart.append(int(near.argmax()))
    return np.array(list(combinations(apart, 2)))


def _cheapest(points: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best of several runs of two-means side by side, from their centroids (r, 2) on: its
    centroids, and for each point whether it is in the second cluster. Of equally good ones
    the first counts.

    A cluster is known by its points' number and sums, so a round is one product of labels
    and points. Runs that came to the same clusters go on as one, and those that stand still
    are done. Points at equal distance are in the first cluster; an empty one stays.
    """
    total, square = points.sum(axis=0), float((points**2).sum())
    best = None
    for left in range(ROUNDS, 0, -1):
        in_second = points @ (second - first).T > ((second**2).sum(axis=1) - (first**2).sum(axis=1)) / 2
        n = in_second.sum(axis=0)[:, None]
        sums = in_second.T.astype(np.float64) @ points
        rest = len(points) - n
        now = np.where(rest > 0, (total - sums) / np.maximum(rest, 1), first), np.where(n > 0, sums / np.maximum(n, 1), second)
        still = (np.abs(now[0] - first) <= 1e-9).all(axis=1) & (np.abs(now[1] - second) <= 1e-9).all(axis=1) | (left == 1)
        for r in np.flatnonzero(still):
            cost = square - (rest[r, 0] * (now[0][r] ** 2).sum() + n[r, 0] * (now[1][r] ** 2).sum())
            if best is None or cost < best[0] - 1e-9 * square:
                best = cost, np.array([now[0][r], now[1][r]]), in_second[:, r]
        if still.all():
            break
        kept = np.sort(np.unique(np.hstack([*now, still[:, None]]), axis=0, return_index=True)[1])
        kept = kept[~still[kept]]
        first, second = now[0][kept], now[1][kept]
    return best[1], best[2]


def _two_means(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and labels of the best of the runs of _starts; of equally good ones the first."""
    starts = _starts(points)
    centres, in_second = _cheapest(points, points[starts[:, 0]], points[starts[:, 1]])
    return centres, in_second.astype(int)


def peeled_centroids(points: np.ndarray, outlier_dist: float = OUTLIER_DIST) -> np.ndarray:
    """Two centroids, the larger cluster's first, of equal ones the one of smaller a,
    then b: the worst point is taken out until none is farther than outlier_dist from its
    centroid; of equally bad ones the first. Two points left are the centroids.

    After each point the clusters are fitted anew: from all starts, since starts are the
    points that lie far out, and so the ones taken out. Time and memory grow with the
    points, not with their pairs. Points are moved to their mean first, which keeps sums of
    squares exact enough.
    """
    middle = points.mean(axis=0) if len(points) else 0.0
    points = points - middle
    while len(points) > 2:
        centres, labels = _two_means(points)
        dist = np.linalg.norm(points - centres[labels], axis=1)
        worst = int(np.flatnonzero(dist >= dist.max() - TIE)[0])
        if dist[worst] <= outlier_dist:
            order = sorted((0, 1), key=lambda k: (-(labels == k).sum(), *centres[k]))
            return centres[order] + middle
        points = np.delete(points, worst, axis=0)
    return points + middle


def team_centroids(chroma: DataFrame, outlier_dist: float = OUTLIER_DIST) -> DataFrame:
    """(match_id, cluster, a, b) of each match with two tracks or more; clusters 0 and 1 by
    falling size. A match has a few dozen tracks, so its group is small."""

    def fit(match: pd.DataFrame) -> pd.DataFrame:
        rows = match.sort_values("track_id")
        if len(rows) < 2:
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("match_id", "str"), ("cluster", "int32"), ("a", "float64"), ("b", "float64"))})
        centres = peeled_centroids(rows[["a", "b"]].to_numpy(dtype=np.float64), outlier_dist)
        return pd.DataFrame({"match_id": rows["match_id"].iloc[0], "cluster": [0, 1], "a": centres[:, 0], "b": centres[:, 1]})

    return chroma.select("match_id", "track_id", "a", "b").groupBy("match_id").applyInPandas(fit, "match_id string, cluster int, a double, b double")


def kit_references(spark, kits: list[tuple[str, ...]]) -> DataFrame:
    """(place, label, kind, ref_a, ref_b) of kits (label, kind, hex), or with match_id of kits
    (match_id, label, kind, hex) of several matches."""
    keyed = any(len(k) == 4 for k in kits)
    schema = "place int, " + ("match_id string, " if keyed else "") + "label string, kind string, hex string"
    rows = spark.createDataFrame([(i, *k) for i, k in enumerate(kits)], schema)
    a, b = chroma_of_hex(F.col("hex"))
    return rows.select(*(["match_id"] if keyed else []), "place", "label", "kind", a.alias("ref_a"), b.alias("ref_b"))


def _with_own(rows: DataFrame, references: DataFrame, wanted: Column, found: Column) -> DataFrame:
    """rows with an aggregate of the wanted references: of their own match, if references
    have match_id, or of all."""
    some = references.where(wanted)
    if "match_id" in references.columns:
        return rows.join(some.groupBy("match_id").agg(found), "match_id", "left")
    return rows.join(F.broadcast(some.agg(found)))  # one row


def label_clusters(centroids: DataFrame, references: DataFrame) -> DataFrame:
    """centroids with team. With both kits known the pairing of least total distance wins,
    ties as they come; with one, the nearer cluster takes it; with none, the first is home.
    References with match_id hold for their own match only."""
    one = [centroids.where(F.col("cluster") == k).select("match_id", F.col("a").alias(f"a{k}"), F.col("b").alias(f"b{k}")) for k in (0, 1)]
    pairs = one[0].join(one[1], "match_id")
    for s in ("home", "away"):
        first = F.min_by(F.struct("ref_a", "ref_b"), "place").alias(s)
        pairs = _with_own(pairs, references, (F.col("kind") == "kit") & (F.col("label") == s), first)

    def to(k: int, side: str):
        return distance(F.col(f"a{k}") - F.col(f"{side}.ref_a"), F.col(f"b{k}") - F.col(f"{side}.ref_b"))

    both = to(0, "home") + to(1, "away") <= to(0, "away") + to(1, "home")
    home_first = F.coalesce(both, to(0, "home") <= to(1, "home"), to(1, "away") < to(0, "away"), F.lit(True))
    named = pairs.select("match_id", home_first.alias("home_first"))
    team = F.when((F.col("cluster") == 0) == F.col("home_first"), "home").otherwise("away")
    return centroids.join(named, "match_id").withColumn("team", team).drop("home_first")


def assign_teams(chroma: DataFrame, labelled: DataFrame, references: DataFrame, outlier_dist: float = OUTLIER_DIST, special_dist: float = SPECIAL_DIST) -> DataFrame:
    """(match_id, track_id, team): the nearest centroid's within outlier_dist, else the
    nearest special colour's closer than special_dist, else null."""
    clusters = labelled.select("match_id", "cluster", F.col("team").alias("c_team"), F.col("a").alias("ca"), F.col("b").alias("cb"))
    d = distance(F.col("a") - F.col("ca"), F.col("b") - F.col("cb"))
    near = chroma.join(clusters, "match_id").withColumn("d", d).groupBy("match_id", "track_id", "a", "b")
    near = near.agg(F.min_by(F.struct("c_team", "d"), F.struct("d", "cluster")).alias("near"))
    specials = F.sort_array(F.collect_list(F.struct("place", "label", "ref_a", "ref_b"))).alias("specials")  # at most three a match
    gaps = F.transform("specials", lambda s: F.struct(distance(F.col("a") - s["ref_a"], F.col("b") - s["ref_b"]).alias("d"), s["place"].alias("place"), s["label"].alias("label")))
    best = F.array_min(F.filter(gaps, lambda s: s["d"] < special_dist))
    team = F.when(F.col("near.d") <= outlier_dist, F.col("near.c_team")).otherwise(best["label"])
    found = _with_own(near, references, F.col("kind") == "special", specials).select("match_id", "track_id", team.alias("team"))
    return chroma.select("match_id", "track_id").join(found, ["match_id", "track_id"], "left")


def with_teams(tracks: DataFrame, teams: DataFrame) -> DataFrame:
    """tracks with team by their track; unknown tracks have none, the ball is `ball`."""
    own = tracks.drop("team").join(teams, ["match_id", "track_id"], "left")
    return own.withColumn("team", F.when(F.col("cls") == "ball", "ball").otherwise(F.col("team")))


def team_counts(teams: DataFrame) -> DataFrame:
    """Tracks of each match by team; null counts those that were sampled but not assigned."""
    return teams.groupBy("match_id", "team").agg(F.count(F.lit(1)).alias("n_tracks"))
