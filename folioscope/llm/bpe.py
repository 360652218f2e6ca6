"""Byte-level BPE by longest matches and backtracking.

Bytes stand for the Latin-1 characters of the same number, so an automaton over
strings finds, in one pass over a pre-token, the longest token that begins at
each byte.  The encoder takes the longest token, then shorter ones, as long as
each two neighbours are compatible: merging their bytes alone gives just these
two.  A row of tokens whose neighbours are all compatible is what the merges
give, and there is one such row at most for each prefix; so a position that led
nowhere never needs another try, and the time is linear in the bytes.

Compatibility is found by plain merging once per pair and remembered.
"""

from __future__ import annotations

from array import array
from collections.abc import Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from folioscope.llm.common import SHORT, per_row, pre_tokens
from folioscope.llm.vocabulary import load_ranks

# Remembered per worker, then forgotten; speed only.  Pieces have SHORT characters at most.
KNOWN_PIECES = 300_000
KNOWN_PAIRS = 1_000_000
FLAT = 1 << 16
WINDOW = 1 << 10


def merged(piece: str, rank: dict[str, int]) -> list[str]:
    """Plain BPE: join the pair of lowest rank, the leftmost first, until none is left."""
    parts = list(piece)
    while len(parts) > 1:
        best, at = None, -1
        for k in range(len(parts) - 1):
            value = rank.get(parts[k] + parts[k + 1])
            if value is not None and (best is None or value < best):
                best, at = value, k
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def reachable(rank: dict[str, int]) -> list[str]:
    """Tokens that merging their own bytes gives; others are used for whole pre-tokens only."""
    return [token for token in rank if len(merged(token, rank)) == 1]


class Backtracker:
    """Encodes one pre-token at a time; ``rank`` maps Latin-1 strings to ids.

    It holds the row so far, in a flat array for a long pre-token, and the places
    that led nowhere.
    """

    def __init__(self, rank: dict[str, int], tokens: list[str]):
        self.rank = rank
        self.matches = ahocorasick.Automaton()
        self.spelled = {rank[token]: token for token in tokens}
        self.size = {number: len(token) for number, token in self.spelled.items()}
        self.widest = max(self.size.values(), default=0)
        self.window = max(WINDOW, 2 * self.widest)
        for number, token in self.spelled.items():
            self.matches.add_word(token, number)
        self.matches.make_automaton()
        self.shorter: dict[int, int] = {}
        for number, token in self.spelled.items():
            for end in range(len(token) - 1, 0, -1):
                if rank.get(token[:end]) in self.size:
                    self.shorter[number] = rank[token[:end]]
                    break
        self.compatible: dict[int, bool] = {}

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two."""
        both = [self.spelled[left], self.spelled[right]]
        if len(self.compatible) >= KNOWN_PAIRS:
            self.compatible.clear()
        known = self.compatible[left << 32 | right] = merged("".join(both), self.rank) == both
        return known

    def encode(self, piece: str) -> Sequence[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        many = len(piece)
        size, shorter, compatible, search = self.size, self.shorter, self.compatible, self.matches.iter_long
        row, window = array("i") if many > FLAT else [], self.window
        dead: set[int] = set()  # places from which no row leads to the end
        ahead, until = None, 0  # the longest token here, then those after it as long as it is taken
        at, last, token = 0, -1, -1
        while at < many:
            if token < 0:
                if ahead is None or at >= until:
                    # A window, as each search copies its text; its last matches may be cut short.
                    ahead = search(piece[at : at + window])
                    until = at + window - self.widest if at + window < many else many
                token = next(ahead)[1]
            end = at + size[token]
            fits = end not in dead
            if fits and last >= 0:
                fits = compatible.get(last << 32 | token)
                if fits is None:
                    fits = self.fits(last, token)
            if fits:
                row.append(token)
                at, last, token = end, token, -1
                continue
            ahead = None
            token = shorter.get(token)
            while token is None:  # nothing fits here: take back the token before this place
                dead.add(at)
                token = row.pop()
                at -= size[token]
                last = row[-1] if row else -1
                token = shorter.get(token)
        return row


def encode_documents(
    docs: DataFrame, ranks_file: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, tokens)``: the ids of each text as unsigned 32-bit little-endian integers.

    Each match of ``pattern`` is encoded by itself; there are no special tokens.
    NULL counts as empty and gives no ids.  Rows that repeat an id get a row each.
    A task holds a text and its ids, a few thousand pre-tokens and what is
    remembered, which has a bound in bytes.
    """
    rank = {token.decode("latin-1"): value for token, value in load_ranks(ranks_file).items()}
    tokens = reachable(rank)

    def begin():
        encoder, split = Backtracker(rank, tokens), regex.compile(pattern)
        known: dict[str, bytes] = {}

        def encode_piece(piece: str) -> bytes:
            found = encoder.encode(piece.encode().decode("latin-1"))
            return np.array(found, dtype="<u4").tobytes()

        def encode(words: str) -> bytes:
            ids = bytearray()
            for pieces in pre_tokens(split, words):
                if len(known) > KNOWN_PIECES:
                    known.clear()
                long = {}
                for piece in set(pieces).difference(known):
                    (known if len(piece) <= SHORT else long)[piece] = encode_piece(piece)
                if long:
                    ids += b"".join(known[x] if x in known else long[x] for x in pieces)
                else:
                    ids += b"".join(map(known.__getitem__, pieces))
            return bytes(ids)

        return lambda texts: [[encode(words or "") for words in texts]]

    return per_row(docs, [key], text, begin, {"tokens": ("binary", pa.binary())})


def decode_documents(
    encoded: DataFrame, ranks_file: str, key: str = "doc_id", tokens: str = "tokens"
) -> DataFrame:
    """``(doc_id, tokens, decoded)`` from ``encode_documents``' ids; ``decoded`` is binary."""
    by_rank = {value: token for token, value in load_ranks(ranks_file).items()}

    def begin():
        spelled = by_rank.__getitem__

        def decode(ids: bytes | None) -> bytes:
            return b"".join(map(spelled, np.frombuffer(ids or b"", dtype="<u4").tolist()))

        return lambda rows: [rows, [decode(ids) for ids in rows]]

    columns = {"tokens": ("binary", pa.binary()), "decoded": ("binary", pa.binary())}
    return per_row(encoded, [key], tokens, begin, columns)
