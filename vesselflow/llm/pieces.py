"""Where a text may be cut for a SentencePiece model so that no piece crosses a cut.

With the white space mark at the start of pieces only, nothing crosses the place before a run of spaces; and no
piece crosses a line feed that no piece contains. A pre-token is a run of spaces with what follows it up to the
next space or line feed, or a line feed with what follows it. Texts start with the dummy space that the model
puts before them.
"""

from __future__ import annotations

import re

import numpy as np

MARK = "▁"
PRE_TOKEN = re.compile(r" +[^ \n]*|\n[^ \n]*")


class PieceModel:
    """The pieces of a SentencePiece file, read with the library."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        ids = list(range(n))
        self.pieces: list[str] = self.library.id_to_piece(ids)
        self.scores: list[float] = self.library.get_score(ids)
        special = [a or b or c for a, b, c in zip(self.library.is_control(ids), self.library.is_unknown(ids), self.library.is_unused(ids), strict=True)]
        byte = self.library.is_byte(ids)
        self.normal = [k for k in ids if not special[k] and not byte[k]]
        self.byte_ids = {int(self.pieces[k][1:-1], 16): k for k in ids if byte[k]}
        self.unknown = self.library.unk_id()
        self.dummy_prefix = self.library.encode("a", out_type=str)[:1] in ([MARK + "a"], [MARK])
        keeps = self.library.normalize(" a  b\nﬁ ") == MARK + "▁a▁▁b\nﬁ▁"
        crossing = any(MARK in p.lstrip(MARK) or "\n" in p for p in (self.pieces[k] for k in self.normal))
        #: Whether texts may be cut at pre-tokens; where not, callers use whole texts.
        self.cuttable = keeps and self.dummy_prefix and not crossing


def pre_token_spans(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the pre-tokens of texts that each begin with their dummy space."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    space = buf == 0x20
    begin = buf == 0x0A
    begin[1:] |= space[1:] & ~space[:-1]
    begin[at[:-1][at[:-1] < at[1:]]] = True
    starts = np.flatnonzero(begin)
    return starts, np.append(starts[1:], len(buf)), np.searchsorted(at, starts, "right") - 1
