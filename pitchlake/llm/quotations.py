"""Conversations without quotes: quoted passages are linked to the messages they repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, small_batches, texts_of

#: Paragraphs and lines with fewer characters are too common to be quotes of another
#: conversation. Three words have as many at least.
LEAST_CHARS = 5
#: Turns of a conversation that are put in order together.
TURN_RANGE = 4096
#: What a passage can be a quote of, from the most to the least certain.
WHOLE, PARAGRAPH, LINE = 0, 1, 2


def level_of(line: str) -> tuple[int, str]:
    """How deeply a line is quoted, and the line without its marks: `> > a` is (2, 'a')."""
    level, rest = 0, line
    while rest.lstrip(" ").startswith(">"):
        level, rest = level + 1, rest.lstrip(" ")[1:]
    return level, rest.removeprefix(" ") if level else line


def passages(text: str) -> list[tuple[int, str]]:
    """Runs of lines of one quote level, in order: (level, text without marks)."""
    levels = map(level_of, text.splitlines())
    return [(level, "\n".join(line for _, line in run)) for level, run in groupby(levels, lambda x: x[0])]


def digest(passage: str) -> bytes | None:
    """A hash of a passage's words in lower case, so that wrapping doesn't matter."""
    words = passage.lower().split()
    return hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest() if words else None


def is_short(part: str) -> bool:
    return len(" ".join(part.split())) < LEAST_CHARS


def parts(passage: str) -> list[tuple[int, int, bytes, bool]]:
    """The whole, its paragraphs and their lines: (kind, number of the paragraph, hash, and
    whether it is a paragraph or line too short to be known elsewhere). A part that says the
    same as the larger one it is in is not listed again."""
    whole, out = digest(passage), []
    if whole is not None:
        out.append((WHOLE, -1, whole, False))
    paragraphs = [list(p) for blank, p in groupby(passage.split("\n"), lambda x: not x.strip()) if not blank]
    for i, lines in enumerate(paragraphs):
        inside, text = {whole}, "\n".join(lines)
        for kind, part in [(PARAGRAPH, text), *((LINE, x) for x in lines)]:
            key = digest(part)
            if key is not None and key not in inside:
                inside.add(key)
                out.append((kind, i, key, is_short(part)))
    return out


def digests(passage: str) -> list[tuple[int, bytes]]:
    """Hashes by which a passage is found: of the whole, its paragraphs and its lines."""
    found = {}
    for kind, _, key, _ in sorted(parts(passage), key=lambda x: x[0]):
        found.setdefault(key, kind)
    return [(kind, key) for key, kind in found.items()]


_KEYS = pa.list_(pa.struct([("kind", pa.int32()), ("key", pa.binary())]))
_PARTS = pa.list_(pa.struct([("kind", pa.int32()), ("paragraph", pa.int32()), ("key", pa.binary()), ("short", pa.bool_())]))
_QUOTES = pa.list_(pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("keys", _PARTS)]))
_PARSED = "conv_id long, turn long, role string, body string, own array<struct<kind:int,key:binary>>, quotes array<struct<passage:int,level:int,keys:array<struct<kind:int,paragraph:int,key:binary,short:boolean>>>>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def keys(passage: str) -> list[dict]:
        return [{"kind": kind, "key": key} for kind, key in digests(passage)]

    def quoted(passage: str) -> list[dict]:
        return [{"kind": kind, "paragraph": i, "key": key, "short": short} for kind, i, key, short in parts(passage)]

    for batch in batches:
        bodies, own, quotes = [], [], []
        for raw in texts_of(batch):
            found = passages((raw or b"").decode())
            body = "\n".join(text for level, text in found if not level).strip("\n")
            bodies.append(body)
            own.append(keys(body))
            quotes.append([{"passage": i, "level": level, "keys": quoted(text)} for i, (level, text) in enumerate(found) if level])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(bodies, pa.string()), pa.array(own, _KEYS), pa.array(quotes, _QUOTES)],
            names=["conv_id", "turn", "role", "body", "own", "quotes"],
        )


def _links(parsed: DataFrame) -> DataFrame:
    """Each quoted passage's originals: (conv_id, turn, passage, level, from_conv, from_turn,
    short), short where only short parts of it are from there.

    A hash's original within a conversation is the first message that has it, and elsewhere
    that of the first other conversation, one of the first two. Both are one row a hash, so
    a common passage is not multiplied.
    """
    own = parsed.select("conv_id", "turn", F.explode("own").alias("own")).select("conv_id", "turn", "own.key")
    quoted = parsed.select("conv_id", "turn", F.explode("quotes").alias("q"))
    quoted = quoted.select("conv_id", "turn", "q.passage", "q.level", F.explode("q.keys").alias("k")).select("conv_id", "turn", "passage", "level", "k.*")
    asked = quoted.groupBy("key").agg(F.min("short").alias("short"))
    said = own.join(asked, "key")
    here = said.groupBy("key", "conv_id").agg(F.min("turn").alias("here_turn"), F.first("short").alias("short"))
    two = here.where("not short").withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("conv_id"))).where("rank <= 2")
    place = F.struct("conv_id", F.col("here_turn").alias("turn"))
    two = two.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("second"))
    found = quoted.join(here.drop("short"), ["key", "conv_id"], "left").join(two, "key", "left")
    here = F.when(F.col("here_turn") < F.col("turn"), F.struct(F.col("conv_id"), F.col("here_turn").alias("turn")))
    other = F.when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).when(F.col("second.conv_id") != F.col("conv_id"), F.col("second"))
    away = F.when(~F.col("short"), other)
    found = found.select("conv_id", "turn", "passage", "level", "kind", "paragraph", "short", here.alias("here"), away.alias("away")).where("here is not null or away is not null")
    return _chosen(found)


def _chosen(found: DataFrame) -> DataFrame:
    """One source for each part, the largest parts first: the whole, else each paragraph,
    else each line of the other paragraphs. In the same conversation comes before elsewhere,
    so what is said in another one is taken for a part only if none within it is here that
    is not short."""
    is_here, is_away = F.col("here").isNotNull(), F.col("away").isNotNull()
    passage, paragraph = Window.partitionBy("conv_id", "turn", "passage"), Window.partitionBy("conv_id", "turn", "passage", "paragraph")
    whole, block = F.col("kind") == WHOLE, F.col("kind") == PARAGRAPH
    found = found.withColumns({
        "whole_here": F.max(whole & is_here).over(passage),
        "whole_away": F.max(whole & is_away).over(passage) & ~F.max(~whole & is_here & ~F.col("short")).over(passage),
    })
    found = found.withColumns({
        "block_here": F.max(block & is_here).over(paragraph),
        "block_away": F.max(block & is_away).over(paragraph) & ~F.max((F.col("kind") == LINE) & is_here & ~F.col("short")).over(paragraph),
    })
    of_whole, of_block = F.col("whole_here") | F.col("whole_away"), F.col("block_here") | F.col("block_away")
    # Where the larger part has no source, or this is it.
    free = whole | (~of_whole & (block | ~of_block))
    away = is_away & F.when(whole, F.col("whole_away")).when(block, F.col("block_away")).otherwise(F.lit(True))
    source = F.when(free & is_here, F.col("here")).when(free & away, F.col("away"))
    links = found.withColumn("source", source).where("source is not null")
    link = ["conv_id", "turn", "passage", "level", F.col("source.conv_id").alias("from_conv"), F.col("source.turn").alias("from_turn")]
    return links.groupBy(*link).agg(F.min("short").alias("short"))


def _over_turns(rows: DataFrame, anchor: Column) -> DataFrame:
    """rows with pos, the place in the conversation by turn from 0, and anchor_turn and
    anchor_pos of the last row at or before it for which anchor holds. Ranges of turns are
    put in order apart, so a very long conversation is not one task's."""
    rows = rows.withColumn("range", F.floor(F.col("turn") / TURN_RANGE)).withColumn("mark", F.when(anchor, F.col("turn")))
    ranges = rows.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"), F.max("mark").alias("top"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("conv_id", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.max("top").over(before).alias("held"))
    order = Window.partitionBy("conv_id", "range").orderBy("turn", "role", "body")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("within", F.row_number().over(order) - 1).withColumn("last", F.max("mark").over(upto))
    same = ["conv_id", "range"]
    return rows.join(ranges, same).withColumn("pos", F.col("first") + F.col("within")).withColumn("anchor_turn", F.coalesce("last", "held")).drop("range", "mark", "within", "last", "held", "first")


def _roots(anchors: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of anchors (conv_id, turn, up, steps): up is the
    anchor above, null at the top. Pointers are doubled until all are at the top."""
    now = anchors
    while now.where("up is not null").limit(1).count():
        above = now.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("up_up"), F.col("steps").alias("up_steps"), F.col("root").alias("up_root"))
        joined = now.join(above, ["conv_id", "up"], "left")
        now = joined.select(
            "conv_id",
            "turn",
            F.col("up_up").alias("up"),
            (F.col("steps") + F.coalesce("up_steps", F.lit(0))).alias("steps"),
            F.when(F.col("up").isNull(), F.col("root")).otherwise(F.coalesce("up_root", "up")).alias("root"),
        )
        now = materialize(now, "reply-roots")
    return now.select("conv_id", "turn", F.col("root").alias("root_turn"), F.col("steps").alias("depth"))


def _previous(rows: DataFrame, keys: list[str], place: str, value: str) -> DataFrame:
    """rows with previous, the value of the row of the same keys before each by place. As in
    _over_turns, ranges of places are put in order apart."""
    rows = rows.withColumn("range", F.floor(F.col(place) / TURN_RANGE))
    ranges = rows.groupBy(*keys, "range").agg(F.max_by(value, place).alias("top"))
    ranges = ranges.select(*keys, "range", F.lag("top").over(Window.partitionBy(*keys).orderBy("range")).alias("held"))
    rows = rows.withColumn("within", F.lag(value).over(Window.partitionBy(*keys, "range").orderBy(place)))
    return rows.join(ranges, [*keys, "range"]).withColumn("previous", F.coalesce("within", "held")).drop("range", "within", "held")


def _starts(anchors: DataFrame) -> DataFrame:
    """(conv_id, turn, start) of anchors (conv_id, turn, pos, up_pos, up_anchor_pos, n_rows)
    of conversations with more than one: the messages before the anchor in reply order.

    An anchor's run, itself and what follows up to the next anchor, is a chain of replies.
    After it come the anchors that reply to its last turn, by turn, each with all below it,
    then those that reply to the turn before, and so on. A walk through this tree enters
    each anchor (2 * pos) and leaves it (2 * pos + 1); the steps before each are summed by
    doubling pointers to them, so neither depth nor width is one task's."""
    children = anchors.where("up_pos is not null").select("conv_id", "pos", "up_pos", "up_anchor_pos")
    together = _previous(children, ["conv_id", "up_pos"], "pos", "pos").select("conv_id", "pos", "up_pos", "up_anchor_pos", "previous")
    answered = children.groupBy("conv_id", "up_anchor_pos", "up_pos").agg(F.max("pos").alias("last")).withColumn("back", -F.col("up_pos"))
    answered = _previous(answered, ["conv_id", "up_anchor_pos"], "back", "last").select("conv_id", "up_anchor_pos", "up_pos", "last", F.col("previous").alias("other"))
    sibling = together.join(answered.drop("last"), ["conv_id", "up_anchor_pos", "up_pos"]).select("conv_id", "pos", F.coalesce("previous", "other").alias("sibling"))
    lowest = answered.groupBy("conv_id", F.col("up_anchor_pos").alias("pos")).agg(F.min_by("last", "up_pos").alias("child"))
    some = anchors.join(children.select("conv_id").distinct(), "conv_id", "left_semi")
    some = some.join(sibling, ["conv_id", "pos"], "left").join(lowest, ["conv_id", "pos"], "left")
    enter = F.struct((2 * F.col("pos")).alias("step"), F.coalesce(2 * F.col("sibling") + 1, 2 * F.col("up_anchor_pos")).alias("up"), F.col("n_rows").alias("total"))
    leave = F.struct((2 * F.col("pos") + 1).alias("step"), F.coalesce(2 * F.col("child") + 1, 2 * F.col("pos")).alias("up"), F.lit(0).cast("long").alias("total"))
    now = materialize(some.select("conv_id", F.explode(F.array(enter, leave)).alias("s")).select("conv_id", "s.*"), "reply-steps")
    while now.where("up is not null").limit(1).count():
        above = now.select("conv_id", F.col("step").alias("up"), F.col("up").alias("up_up"), F.col("total").alias("up_total"))
        moved = now.where("up is not null").join(above, ["conv_id", "up"])
        moved = moved.select("conv_id", "step", F.col("up_up").alias("up"), (F.col("total") + F.col("up_total")).alias("total"))
        now = materialize(moved.unionByName(now.where("up is null")), "reply-steps")
    ends = now.where("step % 2 = 0").select("conv_id", F.expr("step div 2").alias("pos"), "total")
    return anchors.join(ends, ["conv_id", "pos"]).select("conv_id", "turn", (F.col("total") - F.col("n_rows")).alias("start"))


def reply_ordered(messages: DataFrame) -> DataFrame:
    """One row per message of (conv_id, turn, role, text), ready to be read in reply order:
    conv_id, position, reply_position, turn, role, body, reply_to_turn, root_turn, depth,
    n_quotes, quote_levels, n_linked, sources.

    body is the text without quoted lines (lines that begin with `>`). Runs of lines of one
    level are passages; each is linked to the first message that says it, by a hash of its
    words in lower case: the whole passage, else each of its paragraphs, else each line of
    the others, in the same conversation before the quoting turn, else in another one
    (paragraphs and lines of LEAST_CHARS characters or more). sources lists the n_linked distinct (passage, level, conv_id, turn):
    a passage put together from several messages has one for each. A message
    replies to the latest message of its conversation that its outermost quotes are from,
    by their longer parts if those have one;
    without such it replies to the message before it. position numbers a conversation's
    messages from 0 by turn, so that each comes after what it replies to; reply_position
    numbers them from 0 along the tree of replies: after a message come the replies to it by
    turn, each with all that follows from it, so that branches are not interleaved.
    root_turn and depth tell where a thread begins and how many replies lie between.

    Null texts count as empty; their body is empty. Texts of any length are parsed whole. Rows without conv_id or turn are returned
    with null positions, replies, root and depth, and are no sources. Rows that repeat a turn
    are all returned, in order of role and body, with the replies of the turn. Other columns
    are not read. An empty table gives no rows.
    """
    small_batches(messages.sparkSession)
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), "text")
    parsed = materialize(rows.mapInArrow(_parsed, _PARSED), "quotes-parsed")
    placed = parsed.where("conv_id is not null and turn is not null")
    links = materialize(_links(placed), "quotes-links")
    outer = links.where("from_conv = conv_id").groupBy("conv_id", "turn").agg(F.min_by("from_turn", F.struct("level", "short", -F.col("from_turn"))).alias("linked_turn"))

    turns = _over_turns(placed.select("conv_id", "turn", F.lit("").alias("role"), F.lit("").alias("body")), F.lit(False))
    turns = turns.groupBy("conv_id", "turn").agg(F.min("pos").alias("row_pos"), F.count(F.lit(1)).alias("n_rows"))
    turns = turns.join(outer, ["conv_id", "turn"], "left").withColumn("role", F.lit("")).withColumn("body", F.lit(""))
    first_turn = turns.groupBy("conv_id").agg(F.min("turn").alias("first_turn"))
    turns = turns.join(first_turn, "conv_id")
    is_anchor = F.col("linked_turn").isNotNull() | (F.col("turn") == F.col("first_turn"))
    turns = materialize(_over_turns(turns, is_anchor).select("conv_id", "turn", "linked_turn", "pos", "anchor_turn", "row_pos", "n_rows"), "reply-turns")
    place = turns.select("conv_id", F.col("turn").alias("linked_turn"), F.col("anchor_turn").alias("up"), F.col("pos").alias("up_pos"))
    runs = turns.groupBy("conv_id", F.col("anchor_turn").alias("turn")).agg(F.sum("n_rows").alias("n_rows"))
    start = turns.where("turn = anchor_turn").select("conv_id", "turn", "linked_turn", "pos", "row_pos").join(runs, ["conv_id", "turn"])
    anchor_pos = start.select("conv_id", F.col("turn").alias("up"), F.col("pos").alias("up_anchor_pos"))
    anchors = start.join(place, ["conv_id", "linked_turn"], "left").join(anchor_pos, ["conv_id", "up"], "left")
    steps = F.coalesce(F.col("up_pos") - F.col("up_anchor_pos") + 1, F.lit(0))
    root = F.when(F.col("up").isNull(), F.col("turn")).alias("root")
    anchors = materialize(anchors.select("conv_id", "turn", "up", steps.alias("steps"), root, "pos", "up_pos", "up_anchor_pos", "row_pos", "n_rows"), "reply-anchors")
    roots = _roots(anchors.select("conv_id", "turn", "up", "steps", "root"))
    starts = anchors.join(_starts(anchors), ["conv_id", "turn"], "left")
    starts = starts.select("conv_id", "turn", F.col("pos").alias("anchor_pos"), (F.coalesce("start", F.lit(0)) - F.col("row_pos")).alias("shift"))
    roots = roots.join(starts, ["conv_id", "turn"])
    roots = roots.withColumnRenamed("turn", "anchor_turn")
    before = turns.select("conv_id", F.col("turn").alias("before_turn"), (F.col("pos") + 1).alias("pos"))
    threads = turns.join(roots, ["conv_id", "anchor_turn"]).join(before, ["conv_id", "pos"], "left").select(
        "conv_id",
        "turn",
        F.coalesce("linked_turn", "before_turn").alias("reply_to_turn"),
        "root_turn",
        (F.col("depth") + F.col("pos") - F.col("anchor_pos")).alias("depth"),
        "shift",
    )
    source = F.struct("passage", "level", F.col("from_conv").alias("conv_id"), F.col("from_turn").alias("turn"))
    sources = links.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_set(source)).alias("sources"))  # of one turn's own passages

    ordered = _over_turns(placed, F.lit(False)).drop("anchor_turn")
    lost = parsed.where("conv_id is null or turn is null").withColumn("pos", F.lit(None).cast("long"))
    everything = ordered.unionByName(lost.select(*ordered.columns))
    everything = everything.join(threads, ["conv_id", "turn"], "left").join(sources, ["conv_id", "turn"], "left")
    none = F.array().cast("array<struct<passage:int,level:int,conv_id:bigint,turn:bigint>>")
    return everything.select(
        "conv_id",
        F.col("pos").alias("position"),
        (F.col("pos") + F.col("shift")).alias("reply_position"),
        "turn",
        "role",
        "body",
        "reply_to_turn",
        "root_turn",
        "depth",
        F.size("quotes").alias("n_quotes"),
        F.coalesce(F.array_max(F.transform("quotes", lambda q: q["level"])), F.lit(0)).alias("quote_levels"),
        F.size(F.coalesce("sources", none)).alias("n_linked"),
        F.coalesce("sources", none).alias("sources"),
    )
