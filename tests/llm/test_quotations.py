from __future__ import annotations

import random

from pitchlake.llm.quotations import digests, level_of, passages, reply_ordered

SCHEMA = "conv_id long, turn long, role string, text string, body string, n_quotes int"


def messages(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "body", 7) for c, t, r, x in rows], SCHEMA).repartition(3)


def found(spark, rows):
    return {(r.conv_id, r.turn, r.role): r for r in reply_ordered(messages(spark, rows)).collect()}


def test_levels_and_passages():
    assert level_of("plain > text") == (0, "plain > text")
    assert level_of("> one") == (1, "one") and level_of(">>two") == (2, "two") and level_of("> > > three") == (3, "three") and level_of(">") == (1, "")
    assert passages("> a\n> b\n> > c\nd\n\ne") == [(1, "a\nb"), (2, "c"), (0, "d\n\ne")]
    assert passages("") == []


def test_digests_ignore_wrapping_and_case():
    whole = dict((k, d) for k, d in digests("One two\nthree FOUR") if k == 0)
    assert whole == dict((k, d) for k, d in digests("one two three four") if k == 0)
    assert digests(" \n") == [] and [k for k, _ in digests("ok")] == [0]


def test_replies_by_nested_quotes(spark):
    rows = [
        (1, 0, "user", "How do I cook rice well?\n\nAnd what about beans at home?"),
        (1, 1, "assistant", "Rinse the rice and use two cups of water."),
        (1, 2, "user", "Something else entirely, sorry."),
        (1, 3, "user", "> Rinse the rice and use\n> two cups of WATER.\n\nHow long?"),
        (1, 4, "assistant", "> > Rinse the rice and use two cups of water.\n> How long?\n\nTwelve minutes."),
        (1, 5, "user", "> And what about beans at home?\nTell me."),
        (1, 6, "assistant", "Soak them."),
        (2, 0, "user", "> Rinse the rice and use two cups of water.\nIs this right?"),
        (2, 1, "user", "> never said by anyone here\nHm."),
    ]
    out = found(spark, rows)
    by = {(c, t): r for (c, t, _), r in out.items()}
    assert [by[1, t].reply_to_turn for t in range(7)] == [None, 0, 1, 1, 3, 0, 5]
    assert [by[1, t].depth for t in range(7)] == [0, 1, 2, 2, 3, 1, 2]
    assert {by[1, t].root_turn for t in range(7)} == {0} and [by[1, t].position for t in range(7)] == list(range(7))
    assert by[1, 3].body == "How long?" and by[1, 4].body == "Twelve minutes." and by[1, 4].quote_levels == 2 and by[1, 4].n_quotes == 2
    assert [(s.level, s.turn) for s in by[1, 4].sources] == [(2, 1), (1, 3)]
    assert [(s.conv_id, s.turn) for s in by[2, 0].sources] == [(1, 1)] and by[2, 0].reply_to_turn is None
    assert by[2, 1].n_quotes == 1 and by[2, 1].n_linked == 0 and by[2, 1].reply_to_turn == 0


def test_awkward_messages(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, 0, "assistant", ">"), (None, 1, "user", "x"), (1, None, "user", "> x"), (3, -5, None, ""), (3, 10**12, "user", "word " * 20_000)]
    out = reply_ordered(messages(spark, rows)).collect()
    assert len(out) == len(rows)
    assert sorted(r.position for r in out if r.conv_id == 1 and r.turn == 0) == [0, 1, 2]
    assert [r.position for r in out if r.conv_id is None or r.turn is None] == [None, None]
    assert {(r.turn, r.reply_to_turn, r.depth) for r in out if r.conv_id == 3} == {(-5, None, 0), (10**12, -5, 1)}
    assert reply_ordered(messages(spark, rows).limit(0)).count() == 0


def test_long_conversation_is_put_in_order_in_ranges(spark):
    rows = [(1, t, "user", f"message number {t} of many here" + (f"\n> message number {t // 2} of many here" if t and t % 3 == 0 else "")) for t in range(0, 9000, 1)]
    out = {r.turn: r for r in reply_ordered(spark.createDataFrame([(c, t, r, x, "", 0) for c, t, r, x in rows], SCHEMA)).collect()}
    parent = {t: None if t == 0 else t // 2 if t % 3 == 0 else t - 1 for t in range(9000)}
    depth = {0: 0}
    for t in range(1, 9000):
        depth[t] = depth[parent[t]] + 1
    assert all((out[t].position, out[t].reply_to_turn, out[t].depth, out[t].root_turn) == (t, parent[t], depth[t], 0) for t in range(9000))


def test_common_quotes_are_not_multiplied(spark):
    rows = [(c, 0, "user", "the same first words") for c in range(300)] + [(c, 1, "user", "> the same first words\nyes") for c in range(300)]
    out = reply_ordered(messages(spark, rows)).collect()
    assert len(out) == 600 and all(r.reply_to_turn == 0 and [(s.conv_id, s.turn) for s in r.sources] == [(r.conv_id, 0)] for r in out if r.turn == 1)


def walked(rows):
    """Turns along the tree of replies, by hand."""
    below, out, left = {}, [], [None]
    for r in sorted({(r.turn, r.reply_to_turn) for r in rows}):
        below.setdefault(r[1], []).append(r[0])
    while left:
        turn = left.pop()
        out += [turn] * (turn is not None)
        left += reversed(below.get(turn, []))
    return out


def test_reply_position_keeps_branches_together(spark):
    quote = {3: 1, 5: 2, 6: 1, 7: 3, 9: 0, 11: 5}
    rows = [(1, t, "user", f"what number {t} has to say" + (f"\n> what number {quote[t]} has to say" if t in quote else "")) for t in range(13)]
    rows += [(1, 3, "assistant", "once more"), (2, 0, "user", "alone"), (2, 1, "user", "not alone")]
    out = reply_ordered(messages(spark, rows)).collect()
    one = sorted((r for r in out if r.conv_id == 1), key=lambda r: r.reply_position)
    assert [r.reply_position for r in one] == list(range(14))
    assert [r.turn for r in one] == [0, 1, 2, 5, 11, 12, 3, 3, 4, 7, 8, 6, 9, 10]
    assert [r.reply_position for r in sorted(out) if r.conv_id == 2] == [0, 1]


def test_reply_position_of_wide_and_deep_trees(spark):
    rows = [(1, t, "user", f"message number {t} of many here" + (f"\n> message number {u} of many here" if t else "")) for t in range(6000) for u in [0 if t % 2 else max(0, t - 2)]]
    rows += [(2, t, "user", f"other number {t} of many here" + (f"\n> other number {t * 7 % 11 * t // 11} of many here" if t % 4 == 1 else "")) for t in range(200)]
    out = reply_ordered(messages(spark, rows)).collect()
    for conv in (1, 2):
        here = sorted((r for r in out if r.conv_id == conv), key=lambda r: r.reply_position)
        assert [r.reply_position for r in here] == list(range(len(here))) and [r.turn for r in here] == walked(here)


def test_a_passage_has_a_source_for_each_part(spark):
    rows = [
        (1, 0, "user", "the first paragraph is here\nwith a second line of it\n\nand more of the same message"),
        (1, 1, "user", "a different paragraph said later"),
        (1, 2, "user", "one more line of text"),
        (1, 3, "user", "> the first paragraph is here\n> with a second line of it\n>\n> a different paragraph said later\n\nBoth."),
        (1, 4, "user", "> with a second line of it\n> one more line of text\n> never said by anyone at all\n>\n> said in another conversation only\n\nLines."),
        (1, 5, "user", "> a different paragraph said later\n\nWhole."),
        (2, 0, "user", "said in another conversation only"),
        (2, 1, "user", "> with a second line of it\n> said in another conversation only"),
        (3, 0, "user", "> one more line of text\n> said in another conversation only"),
    ]
    by = {(r.conv_id, r.turn): r for r in reply_ordered(messages(spark, rows)).collect()}
    sources = {k: [(s.conv_id, s.turn) for s in r.sources] for k, r in by.items() if r.n_quotes}
    assert sources == {(1, 3): [(1, 0), (1, 1)], (1, 4): [(1, 0), (1, 2), (2, 0)], (1, 5): [(1, 1)], (2, 1): [(1, 0), (2, 0)], (3, 0): [(1, 2), (2, 0)]}
    assert by[1, 3].n_quotes == 1 and by[1, 3].n_linked == 2 and by[1, 3].reply_to_turn == 1 and by[1, 4].reply_to_turn == 2


def test_short_parts_and_scripts_without_spaces(spark):
    rows = [
        (1, 0, "user", "今天天气很好。\n我们去公园散步吧。\n\n晚上一起吃饭怎么样?"),
        (1, 1, "user", "Agreed!\n\nOr another time"),
        (1, 2, "user", "something else is said here"),
        (1, 3, "user", "> 我们去公园散步吧。\n\n好"),
        (1, 4, "user", "> Agreed!\n\nFine."),
        (1, 5, "user", "> 晚上一起吃饭怎么样?\n\n好"),
        (2, 0, "user", "hm\nnothing like the others"),
        (2, 1, "user", "> 晚上一起吃饭怎么样?\n> not known\n\n?"),
        (3, 0, "user", "> hm\n> not known\n\n?"),
        (4, 0, "user", "hm\nfirst of four"),
        (4, 1, "user", "next of four"),
        (4, 2, "user", "> hm\n> nothing like the others\n\nElsewhere as a whole."),
        (4, 3, "user", "> hm\n> next of four\n\nBoth."),
    ]
    by = {(r.conv_id, r.turn): r for r in reply_ordered(messages(spark, rows)).collect()}
    sources = {k: [(s.conv_id, s.turn) for s in r.sources] for k, r in by.items() if r.n_quotes}
    assert sources == {(1, 3): [(1, 0)], (1, 4): [(1, 1)], (1, 5): [(1, 0)], (2, 1): [(1, 0)], (3, 0): [], (4, 2): [(2, 0)], (4, 3): [(4, 0), (4, 1)]}
    assert [by[1, t].reply_to_turn for t in (3, 4, 5)] == [0, 1, 0] and by[4, 2].reply_to_turn == by[4, 3].reply_to_turn == 1


def test_the_first_conversation_that_says_it_quotes_another(spark):
    rows = [
        (1, 0, "user", "begins with something"),
        (1, 1, "user", "> well known words of many\n\nSee.\n\nwell known words of many"),
        (1, 2, "user", "well known words of many"),
        (2, 0, "user", "hm"),
        (2, 4, "user", "well known words of many"),
        (2, 5, "user", "well known words of many"),
        (3, 0, "user", "well known words of many"),
        (4, 0, "user", "> well known words of many\n\nSee."),
        (5, 0, "user", "> only said here\n\nonly said here"),
    ]
    by = {(r.conv_id, r.turn): r for r in reply_ordered(messages(spark, rows)).collect()}
    assert [[(s.conv_id, s.turn) for s in by[k].sources] for k in ((1, 1), (4, 0), (5, 0))] == [[(2, 4)], [(1, 1)], []]


def test_random_links_equal_brute_force(spark):
    rng = random.Random(8)
    sentences = [f"sentence {i} says " + " ".join(rng.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=8)) for i in range(25)]

    def quote(level, sentence):
        words = (sentence.upper() if rng.random() < 0.3 else sentence).split()
        cut = rng.randint(1, len(words))
        lines = [" ".join(words[:cut]), " ".join(words[cut:])]
        return [rng.choice([">", "> "]) * level + " " + line for line in lines if line]

    rows, asked, first = [], {}, {}
    for conv in rng.sample(range(100), 12):
        for turn in range(9):
            body, quotes = sentences[rng.randrange(20)], []
            if rng.random() < 0.6:
                quotes = [(level, rng.randrange(25)) for level in (2, 1)[rng.randint(0, 1) :]]
            lines = [line for level, s in quotes for line in quote(level, sentences[s])]
            rows.append((conv, turn, "user", "\n".join([*lines, body])))
            asked[conv, turn] = [(level, sentences[s]) for level, s in quotes]
            first.setdefault((conv, body), turn)
    out = reply_ordered(messages(spark, rows)).collect()
    linked = 0
    for r in out:
        want = set()
        for level, sentence in asked[r.conv_id, r.turn]:
            here = first.get((r.conv_id, sentence))
            others = sorted((c, t) for (c, s), t in first.items() if s == sentence and c != r.conv_id)
            if here is not None and here < r.turn:
                want.add((level, r.conv_id, here))
            elif others:
                want.add((level, *others[0]))
        assert {(s.level, s.conv_id, s.turn) for s in r.sources} == want
        linked += len(want)
        own = sorted((level, -turn) for level, conv, turn in want if conv == r.conv_id)
        assert r.reply_to_turn == (-own[0][1] if own else r.turn - 1 if r.turn else None)
    assert linked > 60 and any(s.conv_id != r.conv_id for r in out for s in r.sources)
