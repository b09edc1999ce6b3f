"""Token ids of whole texts with a ``tokenizers`` file, through a bounded cache for each worker process.

A tokenizer whose pre-tokenizer drops white space never lets a token cross it, so a text's ids are those of its
pieces between ASCII blanks, joined. Such pieces repeat; their ids are kept as little-endian bytes and a text's
ids are one ``join``. A piece that isn't cached goes to the library. Tokenizers of any other build get whole texts.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa

#: Pieces in one generation of a worker's cache; two generations are held, about 300 bytes a piece. Workers live on through a
#: pipeline's other stages, beside the JVM and one for each core, so twice as many took an executor over its memory.
GENERATION = 160_000
#: Longer pieces are not cached.
MAX_CACHED_BYTES = 256


def _drops_blanks(spec: dict) -> bool:
    """Known to split at white space and to drop it: a Removed/invert split into contractions, letter runs,
    single digits and runs of anything else but white space, after NFC, blank folding and lower-casing."""
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    normal = (spec.get("normalizer") or {}).get("normalizers") or []
    return (
        [x["type"] for x in pre] == ["Split", "ByteLevel"]
        and pre[0]["behavior"] == "Removed"
        and pre[0]["invert"]
        and pre[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and not pre[1]["add_prefix_space"]
        and not pre[1]["use_regex"]
        and [x["type"] for x in normal] == ["NFC", "Replace", "Lowercase"]
        and normal[1]["pattern"] == {"Regex": r"\s+"}
        and normal[1]["content"] == " "
        and not any(c.isspace() or x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"] for c in x["content"])
    )


class WordIds(dict):
    """Ids of the pieces of texts, as bytes of ``dtype``; a dictionary from a piece's UTF-8 to them."""

    def __init__(self, path: str, generation: int = GENERATION):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.generation = generation
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            self.by_piece = _drops_blanks(json.load(f))
        self.old: dict[bytes, bytes] = {}
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        # Letters that NFC leaves alone and that lower to one letter of the same range, with the byte alphabet of the
        # library; a run of them, and a run of ASCII marks after it (no apostrophe), are pre-tokens of their own.
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        latin = [c for c in map(chr, range(0xC0, 0x180)) if c.isalpha() and len(c.lower()) == 1]
        self.latin = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in latin}
        self.plain = re.compile(f"([A-Za-z{''.join(latin)}]+)([!-&(-/:-@\\[-`{{-~]*)")

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, low: str) -> bytes:
        """The ids of a run of lower-case letters, one pre-token: the model alone gives them."""
        key = low.encode()
        ids = self.get(key) or self.old.get(key)
        if ids is None:
            ids = array(self.code, [t.id for t in self.model.tokenize(low if low.isascii() else low.translate(self.latin))]).tobytes()
        return ids

    def _piece(self, text: str) -> bytes:
        plain = self.plain.fullmatch(text)
        if not plain:
            return self._whole(text)
        letters, marks = plain.groups()
        return self._letters(letters.lower()) + (self[marks.encode()] if marks else b"")

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self._piece(piece.decode())
        if len(piece) <= MAX_CACHED_BYTES:
            if len(self) >= self.generation:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        if self.by_piece:
            return b"".join(map(self.__getitem__, text.split()))
        return self._whole(text.decode())


@cache
def word_ids(path: str, generation: int = GENERATION) -> WordIds:
    return WordIds(path, generation)


def texts_of(texts: pa.Array) -> list[bytes]:
    """The UTF-8 of each text; null as empty."""
    return [x or b"" for x in texts.cast(pa.binary() if pa.types.is_string(texts.type) else pa.large_binary()).to_pylist()]
