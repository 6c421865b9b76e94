from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitchlake.contracts import contract, enforce, nan_to_null
from pitchlake.operators import detect, physical, tracking
from pitchlake.operators.ball import processed_grid

DET = "match_id string, frame long, det_id long, cls string, conf double, x1 double, y1 double, x2 double, y2 double"


def players(frames, present=lambda p, f: True, n=3):
    rows = []
    for f in frames:
        for p in range(n):
            if present(p, f):
                x = 100 + 120 * p + 4 * f
                rows.append(("m", f, p, "player", 0.9, float(x), 300.0, x + 40.0, 400.0))
    return rows


def grid(spark, frames, match="m"):
    return spark.createDataFrame([(match, i, f) for i, f in enumerate(frames)], "match_id string, pos long, frame long")


def test_steady_players_keep_their_ids_and_the_ball_has_none(spark):
    rows = players(range(12)) + [("m", f, 9, "ball", 0.8, 500.0 + 9 * f, 300.0, 512.0 + 9 * f, 312.0) for f in range(12)]
    out = tracking.track(spark.createDataFrame(rows, DET), grid(spark, range(12))).toPandas()
    assert set(out[out.cls == "ball"].track_id) == {-1}
    ids = out[out.cls == "player"].groupby("det_id").track_id.unique()
    assert all(len(i) == 1 and i[0] >= 0 for i in ids) and len({i[0] for i in ids}) == 3


def test_track_survives_a_short_occlusion_but_not_a_long_dropout(spark):
    short = tracking.track(spark.createDataFrame(players(range(20), lambda p, f: p != 1 or not 8 <= f <= 11, 2), DET), grid(spark, range(20))).toPandas()
    assert short[short.det_id == 1].track_id.nunique() == 1 and (short.track_id >= 0).all()
    late = [("m", f, d, c, s, x1 + 400, y1, x2 + 400, y2) for _, f, d, c, s, x1, y1, x2, y2 in players(range(100, 103))]
    out = tracking.track(spark.createDataFrame(players(range(3)) + late, DET), grid(spark, range(103))).toPandas()
    assert not set(out[out.frame < 50].track_id) & set(out[out.frame > 50].track_id)


def test_matches_are_tracked_apart_and_row_order_does_not_matter(spark):
    one = spark.createDataFrame(players(range(8)), DET)
    two = one.unionByName(one.withColumn("match_id", F.lit("n")))
    a = tracking.track(two, processed_grid(two)).toPandas()
    b = tracking.track(two.orderBy(F.rand(3)).repartition(7), processed_grid(two)).toPandas()
    key = ["match_id", "frame", "det_id"]
    assert a.sort_values(key).track_id.tolist() == b.sort_values(key).track_id.tolist()
    assert a[a.match_id == "m"].track_id.nunique() == a[a.match_id == "n"].track_id.nunique() == 3


def test_no_detections_and_unknown_backends(spark):
    out = tracking.track(spark.createDataFrame([], DET))
    assert "track_id" in out.columns and out.count() == 0
    with pytest.raises(NotImplementedError):
        tracking.check_backend("botsort")
    with pytest.raises(ValueError):
        tracking.check_backend("other")


def test_assignment_is_optimal():
    from itertools import permutations

    rng = np.random.default_rng(0)
    for n, m in ((3, 3), (2, 5), (4, 3), (1, 1)):
        cost = rng.random((n, m))
        pairs = tracking.assignment(cost)
        small, wide = (cost, m) if n <= m else (cost.T, n)
        best = min(sum(small[i, p] for i, p in enumerate(perm)) for perm in permutations(range(wide), min(n, m)))
        assert len(pairs) == min(n, m) and np.isclose(sum(cost[i, j] for i, j in pairs), best)


def tracks(spark, rows):
    return spark.createDataFrame(rows, "match_id string, track_id long, frame long, t_s double, x_m double, y_m double, team string, player string")


def test_untracked_rows_keep_positions_and_have_no_speed(spark):
    rows = [("m", -1, f, f / 25, x, y, None, None) for f in range(6) for x, y in ((10.0, 30.0), (90.0, 5.0))]
    rows += [("m", 3, f, f / 25, 50 + 0.1 * f, 20.0, "home", None) for f in range(6)]
    out = physical.add_kinematics(tracks(spark, rows), 1).toPandas()
    assert sorted(out[out.track_id < 0].x_m) == [10.0] * 6 + [90.0] * 6 and out[out.track_id < 0].speed_ms.isna().all()
    speeds = out[out.track_id == 3].sort_values("frame").speed_ms
    assert speeds.isna().tolist() == [True] + [False] * 5 and np.allclose(speeds[1:], 2.5)


def test_unnamed_tracks_stay_apart(spark):
    rows = [("m", t, f, f / 25, 10 + t + 0.2 * f, 30.0, "home", None) for t in (1, 2) for f in range(10)]
    out = physical.summarise_player(physical.add_kinematics(tracks(spark, rows), 1)).toPandas()
    assert len(out) == 2 and np.allclose(out.distance_m, 1.6)


def test_no_positions_no_summary(spark):
    out = physical.summarise_player(physical.add_kinematics(tracks(spark, [("m", 1, f, f / 25, None, None, "home", None) for f in range(5)])))
    assert out.count() == 0 and out.columns[1:] == ["team", "player", "track_id", "minutes", "distance_m", "top_speed_ms", "sprints"]


def test_a_sprint_is_above_the_threshold(spark):
    rows = [("m", 1, f, float(f), x, 0.0, "home", "p") for f, x in enumerate((0.0, 7.0, 14.5, 21.5))]
    assert physical.summarise_player(physical.add_kinematics(tracks(spark, rows), 1)).first().sprints == 1


@pytest.mark.parametrize("window", [1, 4, 5])
def test_smoothing_equals_a_centred_rolling_mean(spark, window):
    rng = np.random.default_rng(window)
    x = [None if i in (4, 11) else float(v) for i, v in enumerate(rng.random(20))]
    out = physical.add_kinematics(tracks(spark, [("m", 1, f, f / 25, v, v, "home", None) for f, v in enumerate(x)]), window).toPandas().sort_values("frame")
    want = pd.Series(x, dtype="float64").rolling(window, center=True, min_periods=1).mean()
    assert np.allclose(out.x_m.to_numpy(dtype=float), want.to_numpy(), equal_nan=True)


def test_translation_and_more_matches_change_no_speed(spark):
    rng = np.random.default_rng(0)
    walk = [("m", t, f, f / 25, float(v), float(v), "home", None) for t in range(4) for f, v in enumerate(np.cumsum(rng.normal(0, 0.12, 50)))]
    base = physical.add_kinematics(tracks(spark, walk))
    moved = physical.add_kinematics(tracks(spark, [(m, t, f, s, x + 9, y - 4, a, b) for m, t, f, s, x, y, a, b in walk]).repartition(5))
    both = tracks(spark, walk)
    twice = physical.add_kinematics(both.unionByName(both.withColumn("match_id", F.lit("n"))))
    key = ["track_id", "frame"]
    a, b, c = (d.toPandas().sort_values(key).speed_ms.to_numpy(dtype=float) for d in (base, moved, twice.where("match_id = 'n'")))
    assert np.allclose(a, b, equal_nan=True) and np.allclose(a, c, equal_nan=True) and twice.count() == 2 * base.count()


def test_contracts(spark):
    df = spark.createDataFrame([(1.0, "x", float("nan"))], "x_m double, extra string, y_m double")
    with pytest.raises(ValueError, match=r"\['conf', 'frame', 'match_id'"):
        enforce(df, "tracks_m")
    full = spark.createDataFrame([("m", 1, "1", "2", "ball", "0.5", "1", "2", "3", "4")], "match_id string, extra int, frame string, det_id string, cls string, conf string, x1 string, y1 string, x2 string, y2 string")
    loose, strict = enforce(full, "detections"), enforce(full, "detections", strict=True)
    assert loose.columns == full.columns and strict.schema.names == contract("detections").names
    assert loose.schema["conf"].dataType.typeName() == "float" and loose.first().frame == 1
    assert nan_to_null(df).first().y_m is None


def test_postprocessing_and_strides(spark):
    raw = spark.createDataFrame([("m", 0, r, lab, s, 0.0, 0.0, 1.0, 1.0) for r, (lab, s) in enumerate([("person", 0.9), ("dog", 0.9), ("ball", 0.34), ("ball", 0.35), ("person", 0.5)])], detect.RAW)
    out = detect.postprocess(raw, {"person": "player", "ball": "ball"}).orderBy("det_id").collect()
    assert [(r.det_id, r.cls, r.conf) for r in out] == [(0, "player", 0.9), (1, "ball", 0.35), (2, "player", 0.5)]
    frames = spark.range(20).select(F.lit("m").alias("match_id"), F.col("id").alias("frame"))
    assert [r.frame for r in detect.stride(frames, 3, 4, 2).orderBy("frame").collect()] == [2, 5, 8, 11]
    assert detect.stride(frames, 0).count() == 20 and detect.stride(frames, 1, 0).count() == 20


def test_detector_backends():
    with pytest.raises(RuntimeError, match="licence"):
        detect.backend("ultralytics_yolo")
    with pytest.raises(FileNotFoundError):
        detect.backend("rfdetr", "/missing")
    with pytest.raises(ValueError):
        detect.backend("other")
    assert detect.backend("rtdetr_coco", load=list) is list


def test_inference_runs_in_batches(spark):
    frames = spark.createDataFrame([("m", f, 2, 2, 3, bytes(12)) for f in range(10)], "match_id string, frame long, height int, width int, nChannels int, data binary")

    def load():
        def model(part):
            assert len(part) <= 4
            return pd.DataFrame({"match_id": part.match_id, "frame": part.frame, "rank": 0, "label": "person", "score": 0.9, "x1": 0.0, "y1": 0.0, "x2": 1.0, "y2": 1.0})

        return model

    assert detect.infer(frames, load, 4).count() == 10


def test_hard_cuts(spark):
    rows = [("m", 0, [0.5, 0.5]), ("m", 1, [0.5, 0.5]), ("m", 2, [0.0, 0.0]), ("m", 3, [0.0, 0.0])]
    cuts = detect.shot_boundaries(spark.createDataFrame(rows, "match_id string, frame long, histogram array<double>"))
    assert [r.frame for r in cuts.orderBy("frame").collect()] == [2, 3]
