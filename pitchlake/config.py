"""Configuration of a run: YAML files, resolved on the driver."""

from __future__ import annotations

from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession

#: Sections that may name a file instead of holding their values.
PROFILES = ("camera", "detector", "tracker", "pitch")
UNNAMED = "unnamed_match"


def read_yaml(path: str | Path) -> dict[str, Any]:
    return yaml.safe_load(Path(path).read_text()) or {}


class RunConfig(dict):
    """A run's sections; those missing or empty are {}."""

    def section(self, name: str) -> dict[str, Any]:
        return self.get(name) or {}

    @property
    def match_id(self) -> str:
        return self.section("match").get("match_id") or self.get("match_id") or UNNAMED

    def matches(self) -> list[tuple[str, dict[str, Any]]]:
        """(match_id, section) of each match: those of `matches`, or the one of `match`."""
        return [(m.get("match_id") or self.match_id, m) for m in self.get("matches") or [self.section("match")]]

    @property
    def unnamed(self) -> bool:
        """Whether there is but one match, without an id: then it stands for any."""
        return not self.get("matches") and self.match_id == UNNAMED

    def enabled(self, kind: str, name: str) -> bool:
        """Whether a stage or an output is on, as it is unless switched off."""
        return bool(self.section(kind).get(name, True))


def _profiles(config: dict[str, Any]) -> None:
    """Load the profiles that are named by path."""
    for name in PROFILES:
        if isinstance(config.get(name), str):
            config[name] = read_yaml(config[name])
        elif name in config and config[name] is None:
            config[name] = {}


def resolve(pipeline: str | Path, match: str | Path | list | None = None) -> RunConfig:
    """The pipeline file, with profiles named by path loaded. A match file becomes the
    section `match`; where it names a profile by path, that profile wins. Several match
    files become the list `matches`, each with its own camera, kits and squads; an id that
    two of them have, or one that is missing, is a ValueError."""
    config = RunConfig(read_yaml(pipeline))
    files = match if isinstance(match, list) else [match] if match else []
    if len(files) == 1:
        config["match"] = read_yaml(files[0])
        config.update({k: v for k, v in config["match"].items() if k in PROFILES and isinstance(v, str)})
    elif files:
        config["matches"] = [read_yaml(f) for f in files]
        ids = [m.get("match_id") for m in config["matches"]]
        if None in ids or len(set(ids)) < len(ids):
            raise ValueError(f"matches need an id each: {ids}")
        for section in config["matches"]:
            _profiles(section)
    _profiles(config)
    return config


def squad(spark: SparkSession, config: RunConfig) -> DataFrame:
    """The dimension (match_id, side, shirt, name) of all matches; a player without a name gets
    side and shirt. A squad is a mapping from shirts to players or a list of players with
    their shirts; of players with one shirt the last counts."""
    names = {}
    for match_id, match in config.matches():
        for side in ("home", "away"):
            players = (match.get(side) or {}).get("squad") or {}
            listed = players.items() if isinstance(players, dict) else [(p["shirt"], p) for p in players]
            for shirt, player in listed:
                names[match_id, side, int(shirt)] = (player or {}).get("name") or f"{side} #{int(shirt)}"
    rows = [(*key, name) for key, name in names.items()]
    return spark.createDataFrame(rows, "match_id string, side string, shirt short, name string")


def match_kits(config: RunConfig) -> list[tuple[str, str, str, str]]:
    """(match_id, label, kind, hex) of all matches: kinds are kit and special (goalkeepers and
    the referee)."""
    out = []
    for match_id, match in config.matches():
        for side in ("home", "away"):
            own = match.get(side) or {}
            if own.get("kit_colour"):
                out.append((match_id, side, "kit", own["kit_colour"]))
            if own.get("gk_kit_colour"):
                out.append((match_id, side, "special", own["gk_kit_colour"]))
        if match.get("referee_colour"):
            out.append((match_id, "referee", "special", match["referee_colour"]))
    return out


def kit_colours(config: RunConfig) -> list[tuple[str, str, str]]:
    """(label, kind, hex) of a configuration of one match."""
    return [kit[1:] for kit in match_kits(config)]
