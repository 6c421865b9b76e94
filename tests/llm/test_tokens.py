from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pitchlake.llm import token_files
from pitchlake.llm.packing import packed
from pitchlake.llm.shared import Recent
from pitchlake.llm.token_files import Block, pack_block, read_document, read_token_files, token_files_round_trip, write_token_files
from pitchlake.llm.tokens import encoder

from .conftest import awkward_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
OTHER = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def raw(text):
    return np.array(ids_of(text), dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=12) | st.sampled_from(["It's", "END.", "x.y", "été,", "Straße!!", "ÀÉ##", "<|endoftext|>", "İI", "Σς.", "é", " a", "ﬁ", "\x85b", "'s."]), max_size=12))
def test_ids_equal_the_librarys(parts):
    for text in (" ".join(parts), "\n".join(parts), "".join(parts)):
        assert encoder(PATH).encode([text.encode()]) == [raw(text)]


def test_encoder_of_another_kind_reads_whole_texts():
    library = Tokenizer.from_file(OTHER)
    text = "Two  words.\n"
    assert np.frombuffer(encoder(OTHER).encode([text.encode()])[0], dtype="<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]


def test_recent_results_are_bounded_and_right():
    made = Recent(lambda k: k * 2, most=3)
    assert [made[bytes([i % 7])] for i in range(50)] == [bytes([i % 7]) * 2 for i in range(50)]
    assert len(made) <= 3 and len(made.before) <= 3


def test_token_files_round_trip_of_awkward_rows(awkward, nothing):
    rows = sorted(((r[0], r[1]) for r in awkward_rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for doc, text in rows:
        ids = raw(text)
        want.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    found = token_files_round_trip(awkward, PATH).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want
    assert token_files_round_trip(nothing, PATH).count() == 0


def test_documents_are_read_alone(spark, small, tmp_path):
    path = f"file://{tmp_path}/files"
    write_token_files(small, PATH, path)
    texts = {r.doc_id: r.text for r in small.collect()}
    for doc in (0, 7, 150):
        assert read_document(spark, path, doc) == [ids_of(texts[doc])]
    assert read_document(spark, path, -5) == []
    found = {r.doc_id: r.ids for r in read_token_files(spark, path, with_ids=True).collect()}
    assert found == {d: ids_of(t) for d, t in texts.items()}


def test_blocks_tell_wrong_dictionaries_and_cut_files():
    import hashlib

    import zstandard

    docs = [(5, 2, zstandard.compress(b"12345678")), (None, 1, zstandard.compress(b"abcd"))]
    block = pack_block(hashlib.sha256(b"").digest(), 10, docs)
    read = Block(block, b"")
    assert read.ids == [5, None] and read.raw(0) == b"12345678" and read.raw(1) == b"abcd" and read.first_token == 10
    with pytest.raises(ValueError, match="another dictionary"):
        Block(block, b"x")
    with pytest.raises(ValueError, match="whole block"):
        Block(block[:-1], b"")


def test_small_blocks_give_the_same(small, monkeypatch):
    whole = sorted(map(tuple, token_files_round_trip(small, PATH).collect()))
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 1)
    assert sorted(map(tuple, token_files_round_trip(small, PATH).collect())) == whole


def check_packing(found, rows, length):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    lengths = [sum(n for _, n in s) for _, s in sorted(sequences.items())]
    assert all(n == length for n in lengths[:-1]) and 0 < lengths[-1] <= length
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at and n > 0
            at += n
    assert sorted(sequences) == list(range(len(sequences)))
    want = defaultdict(list)
    for doc, text in rows:
        want[doc].append(raw(text))
    assert set(pieces) == set(want)
    for doc, texts in want.items():
        assert sum(p.length for p in pieces[doc]) == sum(len(t) // 4 for t in texts)
        for p in pieces[doc]:
            assert any(zlib.crc32(t[4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32 and len(t) // 4 == p.doc_tokens for t in texts)


@pytest.mark.parametrize("length", [2048, 7])
def test_packing_of_awkward_rows(awkward, nothing, length):
    check_packing(packed(awkward, PATH, length).collect(), [(r[0], r[1]) for r in awkward_rows()], length)
    assert packed(nothing, PATH, length).count() == 0


def test_packed_ids(small):
    found = packed(small, PATH, 512, with_ids=True).collect()
    texts = {r.doc_id: ids_of(r.text) for r in small.collect()}
    assert all(r.ids == texts[r.doc_id][r.start : r.start + r.length] for r in found)
