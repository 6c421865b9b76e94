"""Recordings: rate, size and number of frames, read from their containers' headers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_META = "path string, fps double, width int, height int, n_frames long"
#: Boxes of an MP4 file that hold boxes.
_NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"moof", b"traf", b"mvex"}


def _number(data: bytes, at: int, size: int = 4, order: str = "big") -> int:
    return int.from_bytes(data[at : at + size], order)


def _mp4_boxes(file: BinaryIO, begin: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, begin, end) of each box's content; content is skipped, not read."""
    while begin + 8 <= end:
        file.seek(begin)
        head = file.read(16)
        if len(head) < 8:
            return
        size, kind, skip = _number(head, 0), head[4:8], 8
        if size == 1:
            size, skip = _number(head, 8, 8), 16
        elif size == 0:
            size = end - begin
        if size < skip:
            return
        yield kind, begin + skip, min(end, begin + size)
        begin += size


def _mp4_tracks(file: BinaryIO, begin: int, end: int, found: dict) -> None:
    """Gather what is known of the tracks into found: by track, under `tracks` in order."""
    for kind, at, stop in _mp4_boxes(file, begin, end):
        if kind == b"trak":
            found.setdefault("tracks", []).append({"n": 0, "ticks": 0})
        if kind in _NESTED:
            _mp4_tracks(file, at, stop, found)
            continue
        if kind not in (b"tkhd", b"mdhd", b"hdlr", b"stsd", b"stts", b"trex", b"tfhd", b"trun"):
            continue
        file.seek(at)
        data = file.read(stop - at)
        after_times = 20 if data[:1] == b"\x01" else 12
        if kind in (b"trex", b"tfhd", b"trun"):
            _mp4_fragment(kind, data, found)
            continue
        if not found.get("tracks"):
            continue
        track = found["tracks"][-1]
        if kind == b"tkhd":
            track["id"] = _number(data, after_times)
        elif kind == b"mdhd":
            track["scale"] = _number(data, after_times)
        elif kind == b"hdlr":
            track["kind"] = data[8:12]
        elif kind == b"stsd":
            track["width"], track["height"] = _number(data, 40, 2), _number(data, 42, 2)
        elif kind == b"stts":
            for i in range(8, 8 + 8 * _number(data, 4), 8):
                track["n"] += _number(data, i)
                track["ticks"] += _number(data, i) * _number(data, i + 4)


def _mp4_fragment(kind: bytes, data: bytes, found: dict) -> None:
    """Frames of fragments: a fragment's header names its track, and each run of samples tells
    their number and, one by one or by default, how long they last."""
    flags = _number(data, 1, 3)
    by_id = {t.get("id"): t for t in found.get("tracks", [])}
    if kind == b"trex":
        found.setdefault("lasts", {})[_number(data, 4)] = _number(data, 12)
    elif kind == b"tfhd":
        at = 8 + (8 if flags & 1 else 0) + (4 if flags & 2 else 0)
        track = _number(data, 4)
        found["now"] = (track, _number(data, at) if flags & 8 else found.get("lasts", {}).get(track, 0))
    elif (track := by_id.get(found["now"][0])) is not None:
        n, last = _number(data, 4), found["now"][1]
        track["n"] += n
        at = 8 + (4 if flags & 1 else 0) + (4 if flags & 4 else 0)
        step = 4 * bin(flags & 0xF00).count("1")
        track["ticks"] += sum(_number(data, at + i * step) for i in range(n)) if flags & 0x100 else n * last


def _avi_meta(file: BinaryIO, begin: int, end: int) -> dict | None:
    """The first video stream of an AVI file's list of headers."""
    stream: dict = {}
    while begin + 8 <= end:
        file.seek(begin)
        head = file.read(12)
        kind, size = head[:4], _number(head, 4, 4, "little")
        if kind == b"LIST" and head[8:12] in (b"hdrl", b"strl"):
            found = _avi_meta(file, begin + 12, min(end, begin + 8 + size))
            if found:
                return found
        elif kind in (b"strh", b"strf"):
            file.seek(begin + 8)
            data = file.read(size)
            if kind == b"strh":
                stream = {"kind": data[:4], "scale": _number(data, 20, 4, "little"), "rate": _number(data, 24, 4, "little"), "n": _number(data, 32, 4, "little")}
            elif stream.get("kind") == b"vids":
                height = int.from_bytes(data[8:12], "little", signed=True)
                fps = stream["rate"] / stream["scale"] if stream["scale"] else 0.0
                return {"fps": fps, "width": _number(data, 4, 4, "little"), "height": abs(height), "n_frames": stream["n"]}
        begin += 8 + size + size % 2
    return None


def container_meta(file: BinaryIO) -> dict | None:
    """fps, width, height and n_frames of an MP4 or AVI file's first video track; None if it
    is no such file or has none. The rate is that of all frames over all their time, 0 if no
    time is known. Only headers are read."""
    size = file.seek(0, 2)
    file.seek(0)
    head = file.read(12)
    if head[:4] == b"RIFF" and head[8:12] == b"AVI ":
        return _avi_meta(file, 12, size)
    found: dict = {}
    _mp4_tracks(file, 0, size, found)
    for track in found.get("tracks", []):
        if track.get("kind") == b"vide":
            fps = track["n"] * track.get("scale", 0) / track["ticks"] if track["ticks"] else 0.0
            return {"fps": fps, "width": track.get("width", 0), "height": track.get("height", 0), "n_frames": track["n"]}
    return None


def _opened(path: str) -> BinaryIO:
    """A file that can be read in ranges, on the worker that asks for them."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return open("/" + rest.lstrip("/"), "rb")
    from pyarrow.fs import FileSystem

    system, inside = FileSystem.from_uri(path)
    return system.open_input_file(inside)


def read_recordings(spark: SparkSession, path: str, opened: Callable[[str], BinaryIO] = _opened) -> DataFrame:
    """One row for each recording of a file, folder or pattern: match_id (the file's name
    without its ending), path, fps, width, height, n_frames, duration_s (0 where the rate is
    unknown). A file that is no MP4 or AVI recording has nulls. A missing path is a
    FileNotFoundError.

    Spark lists the files and deals them out; workers read only ranges with headers, so
    recordings of any size cost a few reads each.
    """
    try:
        listed = spark.read.format("binaryFile").load(path).select("path")
    except AnalysisException as e:
        raise FileNotFoundError(path) from e

    def probe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for name in part["path"]:
                with opened(name) as file:
                    rows.append({"path": name, **(container_meta(file) or {})})
            yield pd.DataFrame(rows, columns=["path", "fps", "width", "height", "n_frames"]).astype({"width": "Int32", "height": "Int32", "n_frames": "Int64"})

    found = listed.mapInPandas(probe, _META)
    match_id = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    duration = F.when(F.col("fps") > 0, F.col("n_frames") / F.col("fps")).when(F.col("fps").isNotNull(), F.lit(0.0))
    return found.select(match_id.alias("match_id"), "*", duration.alias("duration_s"))


def probe_recording(spark: SparkSession, path: str, match_id: str | None = None) -> dict:
    """video_meta of one recording. A missing file is a FileNotFoundError, and one that is no
    recording a ValueError."""
    from .files import video_meta

    row = read_recordings(spark, path).first()
    if row is None:
        raise FileNotFoundError(path)
    if row.fps is None:
        raise ValueError(f"{path}: not an MP4 or AVI recording")
    return video_meta(match_id or row.match_id, row.fps, row.width, row.height, row.n_frames)


def frames_of(recordings: DataFrame) -> DataFrame:
    """(match_id, frame) of all frames of recordings."""
    some = recordings.where("n_frames > 0")
    return some.select("match_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_frames") - 1)).alias("frame"))


def cameras_of(recordings: DataFrame) -> DataFrame:
    """(match_id, fps, image_width, h), as runs of many matches take them, without homographies."""
    return recordings.where("fps is not null").select("match_id", "fps", F.col("width").cast("double").alias("image_width"), F.lit(None).cast("array<double>").alias("h"))
