from __future__ import annotations

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.config import RunConfig
from pitchlake.contracts import contract
from pitchlake.operators import ball, events, possession, report, team, tracking, value
from pitchlake.operators.asof import as_of
from pitchlake.plans import match_run

SETTLED = "match_id string, frame long, possessor_track_id long, team string, dist_m double, settled_track_id long, settled_team string"
BALL = "match_id string, frame long, t_s double, x_m double, y_m double"


@pytest.mark.parametrize("after", [False, True])
def test_as_of_equals_brute_force(spark, after):
    rng = random.Random(3)
    left = [(rng.choice("ab"), i, rng.choice([None, *range(12)])) for i in range(60)]
    right = [(rng.choice("abc"), rng.choice([None, *range(0, 12, 2)]), rng.choice([None, 1, 2, 3]), "x") for _ in range(25)]
    found = as_of(spark.createDataFrame(left, "match_id string, i int, at long"), spark.createDataFrame(right, "match_id string, frame long, v int, w string"), F.col("at"), "frame", "near", ["v", "w"], after=after)
    want = []
    for m, i, at in left:
        can = [r for r in right if r[0] == m and r[1] is not None and at is not None and (r[1] >= at if after else r[1] <= at)]
        place = can and (min if after else max)(r[1] for r in can)
        best = max(((r[2] if r[2] is not None else -1) for r in can if r[1] == place), default=None)
        want.append((i, None if best is None else (None if best == -1 else best, "x")))
    assert sorted((r.i, r.near and tuple(r.near)) for r in found.collect()) == sorted(want)
    assert found.columns == ["match_id", "i", "at", "near"]


def stream(spark, settled, path, **more):
    """action_stream of (frame, possessor, settled) and a ball at (frame, x, y), by type and frame."""
    side = lambda t: None if t is None else "home" if t < 10 else "away"
    rows = [("m", f, p, side(p), 1.0, s, side(s)) for f, p, s in settled]
    at = ball.ball_speed(spark.createDataFrame([("m", f, f / 25, float(x), float(y)) for f, x, y in path], BALL))
    return {(r.frame, r.type_name): r for r in events.action_stream(spark.createDataFrame(rows, SETTLED), at, **more).collect()}


def still(frames, x, y):
    return [(f, x, y) for f in frames]


def test_passes_and_turnovers_have_places_and_results(spark):
    settled = [(f, 1, 1) for f in range(5)] + [(f, None, 1) for f in (5, 6)] + [(f, 2, 2) for f in (7, 8, 9)] + [(f, 12, 12) for f in (12, 13)]
    path = [*still(range(5), 10, 10), (5, 10.3, 10), (6, 10.6, 10), *still(range(8, 14), 11, 10)]
    found = stream(spark, settled, path)
    assert set(found) == {(7, "pass"), (12, "turnover")}
    first, second = found[7, "pass"], found[12, "turnover"]
    assert (first.track_id, first.team, first.result_name, first.start_x, first.end_x, first.t_s) == (1, "home", "success", 10.6, 11.0, 7 / 25)
    assert (second.track_id, second.result_name, second.start_x, second.end_x) == (2, "fail", 11.0, 11.0)


def test_spikes_are_shots_clearances_or_parts_of_passes(spark):
    held = [(f, 1, 1) for f in range(3)]
    shot = still(range(3), 90, 34) + [(f, 90 + 1.5 * (f - 2), 34) for f in range(3, 8)]
    one = stream(spark, held, shot)
    assert list(one) == [(3, "shot")] and (one[3, "shot"].team, one[3, "shot"].result_name, one[3, "shot"].start_x, one[3, "shot"].end_x) == ("home", None, 90.0, 91.5)
    assert list(stream(spark, held, [(f, 105 - x, y) for f, x, y in shot])) == [(3, "shot")]
    assert list(stream(spark, held, [(f, x - 40, y) for f, x, y in shot])) == [(3, "clearance")]
    assert list(stream(spark, held, [(f, 90 - (x - 90) / 9, y + 9 * (x - 90)) for f, x, y in shot])) == [(3, "clearance")]
    after = [(f, 2, 2) for f in range(8, 11)]
    assert list(stream(spark, held + after, shot)) == [(8, "pass")]
    lost = stream(spark, held + [(f, 12, 12) for f in range(8, 11)], shot + still(range(8, 12), 98, 34))
    assert list(lost) == [(3, "shot")] and (lost[3, "shot"].result_name, lost[3, "shot"].end_x) == ("fail", 98.0)
    late = stream(spark, held + [(f, 12, 12) for f in range(98, 101)], shot)
    assert set(late) == {(3, "shot"), (98, "turnover")} and late[3, "shot"].result_name is None and late[98, "turnover"].end_x is None
    twice = stream(spark, held, shot + still(range(8, 10), 98, 34) + [(10, 99.5, 34)])
    assert list(twice) == [(3, "shot")], "only the first spike between two changes counts"
    nobody = stream(spark, [(0, None, None)], shot)
    assert nobody[3, "shot"].track_id is None and nobody[3, "shot"].team is None


def test_no_possession_and_no_ball(spark):
    assert stream(spark, [], still(range(3), 1, 1)) == {}
    only = stream(spark, [(f, 1, 1) for f in range(3)] + [(f, 2, 2) for f in range(3, 6)], [])
    assert list(only) == [(3, "pass")] and only[3, "pass"].start_x is None


def test_a_run_derives_events_from_tracking(spark, tmp_path):
    """Three players beside the ball's way; who has it changes twice."""
    def near(f):
        return 0 if f < 12 else 1 if f < 24 else 2

    rows = [("m", f, p, "player", 0.9, 100.0 + 150 * p, 100.0, 120.0 + 150 * p, 160.0) for f in range(36) for p in range(3)]
    rows += [("m", f, 3, "ball", 0.8, 105.0 + 150 * near(f), 155.0, 115.0 + 150 * near(f), 165.0) for f in range(36)]
    det = spark.createDataFrame(rows, "match_id string, frame long, det_id long, cls string, conf double, x1 double, y1 double, x2 double, y2 double")
    kits = {"home": {"kit_colour": "#D32F2F"}, "away": {"kit_colour": "#1976D2"}}
    config = RunConfig(match={"match_id": "m", **kits}, events={"route": "tracking"}, ball={"max_speed_ms": 5000.0}, outputs={"report": False})
    refs = {r.label: (r.ref_a, r.ref_b) for r in team.kit_references(spark, [("home", "kit", "#D32F2F"), ("away", "kit", "#1976D2")]).collect()}
    chroma = spark.createDataFrame([("m", t, f, *refs[s]) for t, s in ((1, "home"), (2, "home"), (3, "away")) for f in range(4)], "match_id string, track_id long, frame long, a double, b double")
    inputs = match_run.Inputs(det, chroma_samples=chroma, homography=[[105 / 640, 0, 0], [0, -68 / 360, 68], [0, 0, 1]], image_width=640.0)
    run = match_run.execute(config, inputs, f"file://{tmp_path}")
    found = spark.read.parquet(run.outputs["events"])
    assert found.schema.names == contract("events").names and run.stats["events"].first().n_events == 2
    assert [(r.type_name, r.team, r.result_name) for r in found.orderBy("t_s").collect()] == [("pass", "home", "success"), ("clearance", "home", "fail")]
    none = match_run.build(RunConfig(match={"match_id": "m"}), inputs)
    assert none.tables["events"].count() == 0
    with pytest.raises(ValueError, match="route"):
        match_run.build(RunConfig(match={"match_id": "m"}, events={"route": "other"}), inputs)
    with pytest.raises(RuntimeError, match="events"):
        match_run.build(RunConfig(match={"match_id": "m"}, events={"route": "tracking"}, stages={"ball": False}), inputs)


def test_kernel_heatmap_keeps_all_mass_and_equals_numpy(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(20, 15, 300), rng.normal(60, 12, 300)
    rows = [("m", "home", "p" if i % 3 else "q", float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))] + [("m", None, None, 50.0, 30.0), ("m", "home", "p", None, 1.0)]
    tracks = spark.createDataFrame(rows, "match_id string, team string, player string, x_m double, y_m double")
    for width in (None, 4.0, 0.1):
        found = report.kernel_heatmap(tracks, 1.0, width).collect()
        assert abs(sum(r.density for r in found if r.team == "home") - 1) < 1e-9 and abs(sum(r.density for r in found if r.team is None) - 1) < 1e-9
        sigma = [max(v.std(ddof=1) * 300 ** (-1 / 6), 0.5) if width is None else max(width, 0.5) for v in (x, y)]
        grid = np.zeros((105, 68))
        np.add.at(grid, (np.clip(np.floor(x), 0, 104).astype(int), np.clip(np.floor(y), 0, 67).astype(int)), 1 / 300)
        for axis, (n, s) in enumerate(zip((105, 68), sigma, strict=True)):
            d = np.arange(n)[:, None] - np.arange(n)[None]
            kernel = np.where(np.abs(d) <= math.ceil(3 * s), np.exp(-((d / s) ** 2) / 2), 0.0)
            kernel /= kernel.sum(axis=0)
            grid = kernel @ grid if axis == 0 else grid @ kernel.T
        out = np.zeros((105, 68))
        for r in found:
            if r.team == "home":
                out[r.x_bin, r.y_bin] = r.density
        assert np.allclose(out, grid, atol=1e-9)
    some = report.kernel_heatmap(tracks, 5.0, player="q").collect()
    assert {r.team for r in some} == {"home"} and abs(sum(r.density for r in some) * 25 - 1) < 1e-9
    assert report.kernel_heatmap(tracks.limit(0)).collect() == []


def test_values_solve_the_equations(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["pass", "pass", "dribble", "shot", "foul"]), rng.choice(["success", "fail", None]), rng.uniform(-2, 107), rng.uniform(-1, 69), rng.choice([None, rng.uniform(0, 105)]), rng.uniform(0, 68)) for _ in range(4000)]
    actions = spark.createDataFrame(rows, "type_name string, result_name string, start_x double, start_y double, end_x double, end_y double")
    found = value.zone_values(value.zone_counts(actions, (4, 3)), (4, 3), 300)

    def at(x, y):
        return None if x is None else int(min(max(y // (68 / 3), 0), 2) * 4 + min(max(x // (105 / 4), 0), 3))

    n, goals, moved = np.zeros(12), np.zeros(12), np.zeros((12, 12))
    for kind, result, sx, sy, ex, ey in rows:
        if kind == "foul":
            continue
        n[at(sx, sy)] += 1
        if kind == "shot":
            goals[at(sx, sy)] += result == "success"
        elif result == "success" and ex is not None:
            moved[at(sx, sy), at(ex, ey)] += 1
    assert np.allclose(found, np.linalg.solve(np.eye(12) - moved / n[:, None], goals / n), atol=1e-9) and found.min() > 0
    valued = value.value_actions(actions, value.value_table(spark, found, (4, 3)), (4, 3)).collect()
    assert len(valued) == len(rows)
    for r in valued[:500]:
        worth = None if r.type_name == "foul" else float(r.result_name == "success") if r.type_name == "shot" else found[at(r.end_x, r.end_y)] if r.result_name == "success" and r.end_x is not None else 0.0
        assert r.action_value is None if worth is None else abs(r.action_value - (worth - found[at(r.start_x, r.start_y)])) < 1e-12
    assert not value.zone_values(value.zone_counts(actions.limit(0))).any()


def plain_peeling(points, limit):
    """The peeling with a plain fit of two-means from every start after each point."""
    while len(points) > 2:
        best = None
        for start in team._starts(points):
            centres = points[start].copy()
            for _ in range(team.ROUNDS):
                labels = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
                moved = np.array([points[labels == k].mean(axis=0) if (labels == k).any() else centres[k] for k in (0, 1)])
                if np.allclose(moved, centres, rtol=0, atol=1e-9):
                    break
                centres = moved
            cost = ((points - centres[labels]) ** 2).sum()
            if best is None or cost < best[0] - 1e-9:
                best = cost, centres, labels
        _, centres, labels = best
        dist = np.linalg.norm(points - centres[labels], axis=1)
        worst = np.flatnonzero(dist >= dist.max() - team.TIE)[0]
        if dist[worst] <= limit:
            return centres[sorted((0, 1), key=lambda k: (-(labels == k).sum(), *centres[k]))]
        points = np.delete(points, worst, axis=0)
    return points


def test_peeling_equals_a_plain_refit():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(1, 40))
        points = np.concatenate([rng.normal((12, 3), 3, (n, 2)), rng.normal((-12, -3), 3, (n, 2)), rng.uniform(-90, 90, (int(rng.integers(0, 8)), 2))]) + 128
        assert np.allclose(team.peeled_centroids(points, 25.0), plain_peeling(points, 25.0), atol=1e-6)
    same = np.full((9, 2), 3.0)
    assert np.array_equal(team.peeled_centroids(same), [[3.0, 3.0]] * 2) and np.array_equal(team.peeled_centroids(same[:2]), same[:2])


def test_many_tracks_are_peeled_in_bounded_time():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal((12, 3), 3, (5000, 2)), rng.normal((-12, -3), 3, (5000, 2)), rng.uniform(-120, 120, (60, 2))])
    began = time.process_time()
    found = team.peeled_centroids(points, 25.0)
    assert time.process_time() - began < 20 and np.allclose(found[np.argsort(found[:, 0])], [(-12, -3), (12, 3)], atol=0.3)


def test_islands_are_tracked_as_one_pass(spark):
    rng = np.random.default_rng(5)
    rows, places = [], []
    place = 0
    for _ in range(150):
        place += int(rng.choice([1, 1, 1, 2, 5, 9]))
        places.append(place)
        for d in range(int(rng.integers(0, 5))):
            x, y = 80.0 * int(rng.integers(0, 4)) + rng.normal(0, 4), 100 + rng.normal(0, 4)
            rows.append(("m", place, d, "player", float(rng.choice([0.1, 0.9])), x, y, x + 40, y + 90))
    det = spark.createDataFrame(rows, "match_id string, frame long, det_id long, cls string, conf double, x1 double, y1 double, x2 double, y2 double")
    grid = spark.createDataFrame([("m", p, p) for p in range(place + 1)], "match_id string, pos long, frame long")
    both = det.unionByName(det.withColumn("match_id", F.lit("n")))
    lost = F.when(F.col("match_id") == "m", 3).otherwise(6)
    found = tracking.track(both, grid.unionByName(grid.withColumn("match_id", F.lit("n"))), lost_frames=lost).collect()
    table = np.array([(r[1], r[4], *r[5:]) for r in rows])
    for match, kept in (("m", 3), ("n", 6)):
        want = tracking.associate(table[:, 0].astype(int), table[:, 1], table[:, 2:], tracking.ACTIVATION, kept, tracking.MATCHING)
        got = {(r.frame, r.det_id): r.track_id for r in found if r.match_id == match}
        assert [got[r[1], r[2]] for r in rows] == want.tolist() and want.max() > 10 and (want < 0).any()


def test_the_filter_is_that_of_matrices():
    """The separated filter gives the means and covariances of the 8 x 8 one."""
    boxes = np.array([[10.0, 20.0, 50.0, 120.0], [14.0, 21.0, 55.0, 122.0], [17.0, 23.0, 58.0, 125.0]])
    tracks = tracking._Tracks()
    tracks.begin(np.array([1]), boxes[:1], 0)
    h = 100.0
    e, v = tracking.POSITION_PART * h, tracking.SPEED_PART * h
    mean, cov = np.concatenate([tracking._shape(boxes[:1])[0], np.zeros(4)]), np.diag(np.square([2 * e, 2 * e, 1e-2, 2 * e, 10 * v, 10 * v, 1e-5, 10 * v]))
    move = np.eye(8) + np.diag(np.ones(4), 4)
    see = np.eye(4, 8)
    for place in (1, 2):
        h = mean[3]
        e, v = tracking.POSITION_PART * h, tracking.SPEED_PART * h
        mean, cov = move @ mean, move @ cov @ move.T + np.diag(np.square([e, e, 1e-2, e, v, v, 1e-5, v]))
        e = tracking.POSITION_PART * mean[3]
        s = see @ cov @ see.T + np.diag(np.square([e, e, 1e-1, e]))
        gain = cov @ see.T @ np.linalg.inv(s)
        mean, cov = mean + gain @ (tracking._shape(boxes[place : place + 1])[0] - see @ mean), cov - gain @ s @ gain.T
        tracks.predict(place)
        tracks.update(np.array([0]), boxes[place : place + 1], place)
        assert np.allclose(np.concatenate([tracks.at[0], tracks.speed[0]]), mean)
        assert np.allclose(tracks.p[0], np.diag(cov)[:4]) and np.allclose(tracks.s[0], np.diag(cov)[4:]) and np.allclose(tracks.ps[0], np.diag(cov[:4, 4:]))
