"""SentencePiece (unigram) encoding and decoding: an Aho-Corasick automaton over the pieces drives one pass of
Viterbi, and at each position the output links give the pieces that end there, longest first, to relax the best
score.

No piece crosses a pre-token (see ``pieces``), so a text's best segmentation is that of its pre-tokens. A worker
process keeps the ids of recent pre-tokens; those it hasn't met are solved many at a time, position by position.
A character that is no piece costs the lowest piece score less 10 and becomes its bytes' pieces. Of equal scores
the segmentation found first stays: the longest last piece. Scores are summed in double precision.

Null and empty texts have no ids. The white space mark U+2581 in a text is a space to the model. Each row is
encoded, repeated ones too; empty tables give empty results; other columns are not touched.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesselflow.llm.pieces import MARK, PRE_TOKEN, PieceModel
from vesselflow.llm.stage import ship, whole_text

UNKNOWN_PENALTY = 10.0
#: Pre-tokens in one generation of a worker's cache; two generations are held.
GENERATION = 250_000
#: Cells (words x positions) solved at once.
CELLS = 1 << 19


class Automaton:
    """Aho-Corasick over byte strings. Node 0 is the root; ``first`` of a node is the node of the longest string
    that ends there (0: none), ``after`` the next shorter one."""

    def __init__(self, strings: list[bytes], scores: list[float]):
        children: list[dict[int, int]] = [{}]
        word = [-1]
        for k, s in enumerate(strings):
            node = 0
            for c in s:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    word.append(-1)
                node = children[node][c]
            word[node] = k if word[node] < 0 else word[node]
        n = len(children)
        self.step = np.zeros((n, 256), np.int32)
        self.first, self.after = np.zeros(n, np.int32), np.zeros(n, np.int32)
        fail = [0] * n
        queue = [0]
        for u in queue:
            if u:
                self.step[u] = self.step[fail[u]]
                self.after[u] = self.first[fail[u]]
                self.first[u] = u if word[u] >= 0 else self.after[u]
            for c, v in children[u].items():
                fail[v] = int(self.step[u, c]) if u else 0
                self.step[u, c] = v
                queue.append(v)
        self.word = np.array(word, np.int32)
        self.length = np.array([len(strings[k]) if k >= 0 else 0 for k in word], np.int32)
        self.score = np.array([scores[k] if k >= 0 else 0.0 for k in word])


class Encoder(dict):
    """Ids (little-endian, ``dtype``) of pre-tokens, with the spaces of the text in place of the mark."""

    def __init__(self, path: str):
        super().__init__()
        self.model = m = PieceModel(path)
        self.old: dict[bytes, bytes] = {}
        strings = [m.pieces[k].replace(MARK, " ").encode() for k in m.normal]
        scores = [m.scores[k] for k in m.normal]
        self.automaton = Automaton(strings, scores)
        self.ids = np.array(m.normal, np.int64)
        self.unknown = min(scores) - UNKNOWN_PENALTY
        self.dtype = np.dtype("<u2" if len(m.pieces) <= 1 << 16 else "<u4")
        self.byte_ids = np.array([m.byte_ids.get(b, m.unknown) for b in range(256)], np.int64)
        self.bytes_of = [m.pieces[k].replace(MARK, " ").encode() for k in range(len(m.pieces))]
        for b, k in m.byte_ids.items():
            self.bytes_of[k] = bytes([b])

    def solve(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """Ids and scores of the best segmentations."""
        out: list[bytes] = [b""] * len(words)
        scores = np.zeros(len(words))
        order = sorted(range(len(words)), key=lambda k: -len(words[k]))
        lo = 0
        while lo < len(order):
            some = order[lo : lo + max(1, CELLS // max(1, len(words[order[lo]])))]
            for k, ids, s in zip(some, *self._solve([words[k] for k in some]), strict=True):
                out[k], scores[k] = ids, s
            lo += len(some)
        return out, scores

    def _solve(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """``words`` by falling length."""
        a = self.automaton
        sizes = np.array([len(w) for w in words])
        width, n = int(sizes[0]), len(words)
        text = np.zeros((width, n), np.uint8)
        flat = np.frombuffer(b"".join(words), np.uint8)
        column = np.repeat(np.arange(n), sizes)
        text[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), column] = flat
        lead = (text & 0xC0) != 0x80
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0
        back = np.full((width + 1, n), -1, np.int32)  # the last piece, as an index of ids; -1: the last character
        span = np.zeros((width + 1, n), np.int32)  # its bytes
        state = np.zeros(n, np.int32)
        char_at = np.zeros(n, np.int64)
        for i in range(1, width + 1):
            active = int(np.searchsorted(-sizes, -i, "right"))
            char_at[:active] = np.where(lead[i - 1, :active], i - 1, char_at[:active])
            state = a.step[state[:active], text[i - 1, :active]]
            ends = (sizes[:active] == i) | (lead[i, :active] if i < width else True)
            char = i - char_at[:active]
            node = a.first[state]
            top, piece, length = np.full(active, -np.inf), np.full(active, -1, np.int32), np.zeros(active, np.int32)
            alone = np.zeros(active, bool)
            live = np.flatnonzero(node)
            while len(live):
                at = node[live]
                size = a.length[at]
                score = best[i - size, live] + a.score[at]
                better = score > top[live]
                won = live[better]
                top[won], piece[won], length[won] = score[better], a.word[at[better]], size[better]
                alone[live] |= size == char[live]
                node[live] = a.after[at]
                live = live[node[live] > 0]
            odd = np.flatnonzero(ends & ~alone)
            if len(odd):
                score = best[i - char[odd], odd] + self.unknown
                better = score > top[odd]
                won = odd[better]
                top[won], piece[won], length[won] = score[better], -1, char[won]
            best[i, :active], back[i, :active], span[i, :active] = top, piece, length
        # back from the ends, all words at once; an unknown character gives the ids of its bytes
        position, found = sizes.copy(), []
        rows = np.flatnonzero(position)
        while len(rows):
            at = position[rows]
            piece, length = back[at, rows], span[at, rows]
            known = piece >= 0
            found.append((rows[known], at[known], self.ids[piece[known]]))
            for k in range(int(length[~known].max(initial=0))):
                far = ~known & (length > k)
                found.append((rows[far], at[far] - k, self.byte_ids[text[at[far] - 1 - k, rows[far]]]))
            position[rows] = at - length
            rows = rows[position[rows] > 0]
        if not found:
            return [b""] * n, best[0]
        row, place, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        ids = ids[np.lexsort((place, row))].astype(self.dtype)
        cuts = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))) * self.dtype.itemsize
        raw = ids.tobytes()
        return [raw[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], best[sizes, np.arange(n)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        if self.model.cuttable:
            keys = [[w.encode() for w in PRE_TOKEN.findall(" " + t)] if t else [] for t in (t.replace(MARK, " ") for t in texts)]
        else:
            keys = [[(" " + t.replace(MARK, " ")).encode()] if t else [] for t in texts]
        need = set().union(*keys) - self.keys()
        new = [w for w in need if w not in self.old]
        solved = dict(zip(new, self.solve(new)[0], strict=True)) if new else {}
        solved.update((w, self.old[w]) for w in need if w in self.old)
        if len(self) + len(solved) > GENERATION:
            self.old = {w: x for w, x in self.items() if len(w) <= 256}
            solved.update((w, self[w]) for w in set().union(*keys) if w in self)
            self.clear()
        self.update(solved)
        return [b"".join(map(self.__getitem__, k)) for k in keys]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the dummy space; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return raw.removeprefix(b" ").decode(errors="replace")


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _some(array: pa.Array, texts: int = 256):
    for lo in range(0, len(array), texts):
        yield [t or "" for t in array.slice(lo, texts).to_pylist()]


def encode(docs: DataFrame, path: str, name: str = "piece_ids") -> DataFrame:
    """``docs`` with the piece ids of its texts in the list column ``name``."""
    ship(docs.sparkSession)

    def run(array: pa.Array) -> pa.Array:
        e = encoder(path)
        return pa.array([np.frombuffer(x, e.dtype).astype(np.int32) for texts in _some(array) for x in e.encode(texts)], pa.list_(pa.int32()))

    return docs.withColumn(name, F.arrow_udf(run, "array<int>")(whole_text()))


def decode(rows: DataFrame, path: str, ids: str = "piece_ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the texts of the list column ``ids`` in the column ``name``."""
    ship(rows.sparkSession)

    def run(array: pa.Array) -> pa.Array:
        e = encoder(path)
        return pa.array([e.decode(x or []) for x in array.to_pylist()], pa.string())

    return rows.withColumn(name, F.arrow_udf(run, "string")(F.col(ids)))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_pieces``, ``pieces_crc32`` (ids as little-endian unsigned 32-bit integers) and whether
    decoding gives the text back, from one pass that keeps no ids."""
    ship(docs.sparkSession)

    def run(array: pa.Array) -> pa.Array:
        e = encoder(path)
        rows = []
        for texts in _some(array):
            for text, raw in zip(texts, e.encode(texts), strict=True):
                ids = np.frombuffer(raw, e.dtype)
                rows.append({"n_pieces": len(ids), "pieces_crc32": zlib.crc32(ids.astype("<u4")), "same": e.decode(ids.tolist()) == text})
        return pa.array(rows, pa.struct([("n_pieces", pa.int64()), ("pieces_crc32", pa.int64()), ("same", pa.bool_())]))

    kind = "struct<n_pieces: bigint, pieces_crc32: bigint, same: boolean>"
    return docs.select("doc_id", F.arrow_udf(run, kind)(whole_text()).alias("r")).select("doc_id", "r.*")
