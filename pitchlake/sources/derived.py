"""Tracking tables derived from the event stream, order lines and the other given tables.

The recipes are SQL that Spark and DuckDB read alike, so a query and its oracle start from
the same rows. A match is a run of 2,500 events: more input means more matches.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: A perspective homography from 1280 x 720 pixels to metres, row by row.
HOMOGRAPHY = ((0.085, 0.004, 1.5), (0.0, -0.098, 69.0), (0.0, 0.00012, 1.0))

_H = [v for row in HOMOGRAPHY for v in row]
_X, _Y = "((x1 + x2) / 2e0)", "y2"
_W = f"({_H[6]}e0 * {_X} + {_H[7]}e0 * {_Y} + {_H[8]}e0)"

VIEWS = {
    "det": """
        SELECT concat('m', CAST(CAST(floor(event_id / 2500e0) AS bigint) AS varchar(20))) AS match_id,
               CAST(floor((event_id % 2500) / 5e0) AS bigint) AS frame,
               CAST(event_id % 5 AS bigint) AS det_id,
               CASE event_type WHEN 'purchase' THEN 'ball' WHEN 'error' THEN 'referee'
                               WHEN 'signup' THEN 'goalkeeper' ELSE 'player' END AS cls,
               3.5e-1 + (event_id * 37 % 64) / 1e2 AS conf,
               CAST((user_id * 13 + event_id) % 1240 AS double) AS x1,
               CAST((user_id * 29 + CAST(floor(event_id / 50e0) AS bigint)) % 660 AS double) AS y1,
               CAST((user_id * 13 + event_id) % 1240 + 20 AS double) AS x2,
               CAST((user_id * 29 + CAST(floor(event_id / 50e0) AS bigint)) % 660 + 60 AS double) AS y2,
               user_id
        FROM {events}""",
    "det_strided": """
        SELECT * FROM {det} WHERE frame % 4 = 0""",
    "tracks_px": """
        SELECT match_id, frame, det_id, cls, conf, x1, y1, x2, y2,
               CASE WHEN cls = 'ball' THEN CAST(-1 AS bigint) ELSE CAST(user_id % 22 AS bigint) END AS track_id,
               CASE WHEN cls = 'ball' THEN 'ball' WHEN cls = 'referee' THEN 'referee'
                    WHEN user_id % 22 < 10 THEN 'home' WHEN user_id % 22 < 20 THEN 'away' END AS team,
               CASE WHEN user_id % 3 > 0 THEN concat('p', CAST(user_id % 22 AS varchar(20))) END AS player
        FROM {det}""",
    "tracks_m": f"""
        SELECT match_id, frame, det_id, cls, frame / 25e0 AS t_s, track_id, team, player, conf,
               ({_H[0]}e0 * {_X} + {_H[1]}e0 * {_Y} + {_H[2]}e0) / {_W} AS x_m,
               ({_H[3]}e0 * {_X} + {_H[4]}e0 * {_Y} + {_H[5]}e0) / {_W} AS y_m
        FROM {{tracks_px}}""",
    # A game of short spells: the ball stays with a player for seven frames, then rolls to the
    # next one's spot, near by three times and far the fourth.
    "play": """
        SELECT match_id, frame, det_id, CASE WHEN det_id = 0 THEN 'ball' ELSE 'player' END AS cls, frame / 25e0 AS t_s, track_id,
               CASE WHEN det_id > 0 THEN CASE WHEN track_id < 11 THEN 'home' ELSE 'away' END END AS team, concat('p', CAST(track_id AS varchar(20))) AS player, conf,
               CASE WHEN det_id = 0 THEN x0 + roll * (x1 - x0) WHEN det_id = 1 THEN x0 + away ELSE x0 + 9 + det_id END AS x_m,
               CASE WHEN det_id = 0 THEN y0 + roll * (y1 - y0) WHEN det_id = 1 THEN y0 ELSE y0 + det_id END AS y_m
        FROM (
            SELECT match_id, frame, det_id, conf,
                   CASE WHEN det_id = 0 THEN CAST(-1 AS bigint) ELSE (spell * spell * 3 + spell * 5 + det_id * 5) % 22 END AS track_id,
                   CASE WHEN frame % 10 > 6 THEN (frame % 10 - 6) / 4e0 ELSE 0e0 END AS roll,
                   CASE WHEN user_id % 7 = 0 THEN 5e0 ELSE (user_id % 5 - 2) * 3e-1 END AS away,
                   8e0 + CAST(floor(spell / 4e0) AS bigint) * 37 % 80 + spell % 4 * 15e-1 AS x0, 6e0 + CAST(floor(spell / 4e0) AS bigint) * 23 % 56 AS y0,
                   8e0 + CAST(floor((spell + 1) / 4e0) AS bigint) * 37 % 80 + (spell + 1) % 4 * 15e-1 AS x1,
                   6e0 + CAST(floor((spell + 1) / 4e0) AS bigint) * 23 % 56 AS y1
            FROM (SELECT *, CAST(floor(frame / 10e0) AS bigint) AS spell FROM {det})
        )""",
    # Players that stay in lanes of their own, each seen in one frame of three.
    "lanes": """
        SELECT match_id, frame, det_id, 'player' AS cls, CASE WHEN user_id % 4 = 0 THEN 2e-1 ELSE 9e-1 END AS conf,
               det_id * 2e2 + user_id % 5 % 3 AS x1, 3e2 AS y1, det_id * 2e2 + user_id % 5 % 3 + 40 AS x2, 4e2 AS y2
        FROM {det} WHERE user_id % 3 = 0""",
    "shots": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
               54e0 + l_quantity * 1.02e0 AS start_x, 14e0 + l_discount * 4e2 AS start_y,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_goal
        FROM {lineitem}""",
    # The lanes with the ball, as a run of all stages reads them; and what is read of shirts.
    "lanes_and_ball": """
        SELECT match_id, frame, det_id, cls, conf, x1, y1, x2, y2 FROM {lanes}
        UNION ALL
        SELECT match_id, frame, det_id + 5, cls, conf, x1, y1, x2, y2 FROM {det} WHERE cls = 'ball'""",
    "lane_readings": """
        SELECT match_id, frame + 1 AS track_id, det_id AS seq, CAST(frame * 7 % 40 AS integer) AS number FROM {det}""",
    # Matches of two kinds, by turns: two cameras, kits the other way round, and two squads.
    "two_cameras": """
        SELECT match_id, odd, CASE WHEN odd = 1 THEN 5e1 ELSE 25e0 END AS fps, CASE WHEN odd = 1 THEN 192e1 END AS image_width
        FROM (SELECT match_id, CAST(max(CAST(floor(event_id / 2500e0) AS bigint)) % 2 AS integer) AS odd
              FROM (SELECT event_id, concat('m', CAST(CAST(floor(event_id / 2500e0) AS bigint) AS varchar(20))) AS match_id FROM {events}) GROUP BY match_id)""",
    "two_squads": """
        SELECT match_id, side, CAST(shirt AS smallint) AS shirt, CASE WHEN odd = 1 THEN concat('odd ', name) ELSE name END AS name
        FROM {two_cameras} CROSS JOIN {squad} WHERE shirt < 35 + odd""",
    # Actions that go towards x = 105.
    "moves": """
        SELECT l_orderkey, l_linenumber, l_suppkey % 7 AS team_no, start_x, start_y, end_y,
               CASE WHEN start_x > 80 AND l_returnflag = 'R' THEN 'shot' WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'foul' ELSE 'pass' END AS type_name,
               CASE WHEN l_linestatus = 'F' THEN 'success' ELSE 'fail' END AS result_name,
               CASE WHEN l_linenumber < 6 OR start_x > 80 THEN start_x + l_quantity * 4e-1 END AS end_x
        FROM (
            SELECT *, CAST((l_orderkey * 7 + l_linenumber * 13) % 105 AS double) AS start_x,
                   CAST(l_partkey * 3 % 68 AS double) AS start_y, CAST(l_suppkey * 5 % 68 AS double) AS end_y FROM {lineitem}
        )""",
    "readings": """
        SELECT concat('m', CAST(user_id % 7 AS varchar(20))) AS match_id, user_id AS track_id, event_id AS seq,
               CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS bigint) % 3 END AS number
        FROM {events}""",
    "actions": """
        SELECT concat('m', CAST(CAST(floor(event_id / 2500e0) AS bigint) AS varchar(20))) AS match_id, event_id,
               CASE event_type WHEN 'click' THEN 'pass' WHEN 'view' THEN 'corner' WHEN 'error' THEN 'foul' ELSE event_type END AS type_name
        FROM {events}""",
    # A tagging sheet: an action every few seconds of each match's clock.
    "tags": """
        SELECT match_id, event_id, CAST(1 + event_id % 2 AS integer) AS period, CAST(event_id % 5400 AS bigint) AS second_of_match,
               CASE WHEN event_id % 3 = 0 THEN 'home' ELSE 'away' END AS team, CAST(event_id % 40 AS integer) AS shirt, type_name,
               CAST(event_id % 105 AS double) AS start_x, CAST(event_id % 68 AS double) AS start_y,
               CASE WHEN event_id % 5 > 0 THEN CAST(event_id * 3 % 105 AS double) END AS end_x, CASE WHEN event_id % 5 > 0 THEN CAST(event_id * 7 % 68 AS double) END AS end_y,
               CASE WHEN event_id % 2 = 0 THEN 'success' ELSE 'fail' END AS result_name, 'foot_right' AS bodypart_name, '' AS note
        FROM {actions}""",
    "squad": """
        SELECT CASE WHEN c_nationkey < 13 THEN 'home' ELSE 'away' END AS side, CAST(c_custkey % 99 AS bigint) AS shirt, min(c_name) AS name
        FROM {customer} GROUP BY 1, 2""",
    "sightings": """
        SELECT event_id, CASE WHEN user_id % 5 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'home' ELSE 'away' END AS team,
               CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 120 AS bigint) END AS shirt
        FROM {events}""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view, or a given table."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs = set(re.findall(r"\{(\w+)\}", VIEWS[name]))
    return spark.sql(VIEWS[name], **{n: view(spark, sf_dir, n) for n in needs})


def with_views(sql: str) -> str:
    """sql, whose {names} are derived views, as one statement over the given tables."""
    needs: dict[str, str] = {}

    def add(text: str) -> str:
        for name in re.findall(r"\{(\w+)\}", text):
            if name in VIEWS and name not in needs:
                needs[name] = add(VIEWS[name])
        return re.sub(r"\{(\w+)\}", r"\1", text)

    body = add(sql).strip()
    if not needs:
        return body
    views = ",\n".join(f"{name} AS ({text})" for name, text in needs.items())
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {views},\n{body[len('WITH RECURSIVE') :]}"
    return f"WITH {views},\n{body[4:]}" if body.upper().startswith("WITH") else f"WITH {views}\n{body}"
