"""Token ids of texts, by the tokenizers library."""

from __future__ import annotations

import json
import os

import numpy as np

from .shared import Recent, pieces

#: The id that ends each document.
END_ID = 1
#: Words, and parts of words, of which a worker remembers the ids (up to twice as many).
WORDS, PARTS = 220_000, 260_000

#: ASCII punctuation that can end a word; an apostrophe can begin a token of its own.
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
#: Words by which encoding in parts is tried out before it is used.
_TRIAL = "It's a 12 (x) don't! END. end.### Thner,*** Élan été, Straße!! ñandú | || a.b x-y é́é ́a 3.5% µm ÀÉÎ## ÿ. naïve...".split()

# What a tokenizer file must declare for its texts to be encoded in parts.
# White space is made one space and parts texts before the model, and no token holds any.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def declares_words(tokenizer_json: str) -> bool:
    """Whether a tokenizer file's own declarations say that the ids of a text are those of its
    words in turn, and of a word's letters and closing punctuation: the normalizers and
    pre-tokenizers above, a byte-pair model without dropout or unknown token, nothing added
    after it, and no added token that has white space or takes it up."""
    file = json.loads(tokenizer_json)
    model = file["model"]
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    whole = [t for t in file["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"].split()) != 1]
    normalizer, parts = file["normalizer"] or {}, file["pre_tokenizer"] or {}
    return plain and not whole and file["post_processor"] is None and normalizer.get("normalizers") == _NORMALIZERS and parts.get("pretokenizers") == _PRE_TOKENIZERS


class Encoder:
    """Ids of whole texts, exactly as the tokenizer gives them for the whole text.

    Many tokenizers part texts at white space before anything else and drop it, so that a
    text's ids are those of its words (parted by ASCII white space) in turn; and of a word
    of letters and closing punctuation, those of these two parts, whatever the case. Then
    ids of words and parts are remembered, and new parts go straight to the tokenizer's
    model. This is done only if the file declares just such components (declares_words), and
    is tried out on a few words besides; any other tokenizer encodes whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_names = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xA1, 0x100)}
        n_ids = max(self.tokenizer.get_vocab().values()) + 1
        self.id_bytes = [i.to_bytes(4, "little") for i in range(n_ids)]
        self.parts, self.words = Recent(self._part, PARTS), Recent(self._word, WORDS)
        whole = b"".join(self._whole(w) for w in _TRIAL)
        self.by_words = declares_words(self.tokenizer.to_str()) and self._whole("\n".join(_TRIAL)) == self._whole("  ".join(_TRIAL)) == whole
        self.in_parts = self.by_words and all(self._word(w.encode()) == self._whole(w) for w in _TRIAL)
        if not self.in_parts:
            self.words = Recent(lambda word: self._whole(word.decode()), WORDS)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: bytes) -> bytes:
        """Ids of letters in lower case, or of punctuation: one word to the model."""
        text = part.decode()
        name = text if text.isascii() else text.lower().translate(self.byte_names)
        return b"".join([self.id_bytes[t.id] for t in self.model.tokenize(name)])

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters alone
            return self.parts[word.lower()]
        if max(word) < 0xC4:  # ASCII and Latin-1: nothing to compose, and cases pair up
            letters = word.rstrip(_PUNCTUATION)
            if letters.decode().isalpha():
                ids = self.parts[letters.lower()]
                return ids + self.parts[word[len(letters) :]] if len(letters) < len(word) else ids
        return self._whole(word.decode())

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Each text's ids with END_ID, as little-endian unsigned 32-bit integers."""
        end = np.array([END_ID], dtype="<u4").tobytes()
        if not self.by_words:
            return [self._whole((t or b"").decode()) + end for t in texts]
        ids_of = self.words.__getitem__
        return [b"".join([b"".join(map(ids_of, p.split())) for p in pieces(t or b"")]) + end for t in texts]
