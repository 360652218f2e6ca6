"""Token counts under a unigram model, the forward scores shared in a trie.

Distinct pre-tokens go into a trie.  Each node keeps the best score of any way to
cut its prefix into pieces of the vocabulary, and the number of pieces of that
way; both follow from the nodes above it, so a prefix that many words share is
scored once.  The number at a word's last node is the word's token count, and a
document's count is the sum over its pre-tokens.  The trie is kept across the
batches of a task and begun anew when it has ``NODES`` nodes.  A long pre-token,
which no other would share, is scored by itself in a window as wide as the
widest piece.  So memory is bounded but for the text; no rows are shuffled.

A piece's score is its log probability under Zipf's law for its rank in a
public vocabulary; nothing is trained.
"""

from __future__ import annotations

import math

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from folioscope.llm.common import SHORT, per_row, pre_tokens
from folioscope.llm.vocabulary import load_ranks

NODES = 1_000_000
KNOWN_PIECES = 500_000


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """log p of each piece, p in proportion to 1 / (rank + 1)."""
    total = math.log(math.fsum(1 / (rank + 1) for rank in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


def _backwards(scores: dict[bytes, float]) -> dict:
    """Pieces as a trie from their last byte to their first; the score is under -1."""
    root: dict = {}
    for piece, score in scores.items():
        node = root
        for byte in reversed(piece):
            node = node.setdefault(byte, {})
        node[-1] = score
    return root


class ForwardTrie:
    """Token counts of pre-tokens; of equal scores the cut with fewer pieces wins."""

    def __init__(self, scores: dict[bytes, float]):
        self.endings = _backwards(scores)
        self.widest = max(map(len, scores), default=1)
        self.clear()

    def clear(self) -> None:
        self.below: dict[int, int] = {}
        self.best, self.pieces = [0.0], [0]

    def count(self, word: bytes) -> int:
        best, pieces = self.best, self.pieces
        path = [0]
        for end, byte in enumerate(word, 1):
            step = path[-1] << 8 | byte
            node = self.below.get(step)
            if node is None:
                node = self.below[step] = len(best)
                score, many = self._extend(word, end, best, pieces, path)
                best.append(score)
                pieces.append(many)
            path.append(node)
        return pieces[path[-1]]

    def count_long(self, word: bytes) -> int:
        """The same of a long word that no other shares: a window of scores as wide as the widest piece."""
        keep = self.widest
        best, pieces = [0.0], [0]
        done = 0  # the place that the window begins at
        for end in range(1, len(word) + 1):
            if len(best) > 8 * keep:
                cut = len(best) - keep
                del best[:cut], pieces[:cut]
                done += cut
            score, many = self._extend(word, end, best, pieces, None, done)
            best.append(score)
            pieces.append(many)
        return pieces[-1]

    def _extend(self, word, end, best, pieces, path, done=0) -> tuple[float, int]:
        """The best cut of ``word[:end]`` from those of its prefixes, found through ``path`` or by place."""
        node, found = self.endings, (-math.inf, 0)
        for start in range(end - 1, -1, -1):
            node = node.get(word[start])
            if node is None:
                break
            score = node.get(-1)
            if score is not None:
                before = start - done if path is None else path[start]
                found = max(found, (best[before] + score, -pieces[before] - 1))
        if found[1] == 0:
            raise ValueError("the vocabulary lacks a byte")
        return found[0], -found[1]


def count_tokens(
    docs: DataFrame,
    ranks_file: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    nodes: int = NODES,
) -> DataFrame:
    """``(doc_id, n_pretokens, n_tokens)`` per row of ``docs``.

    NULL and empty texts have none.  Rows that repeat an id get a row each; an
    empty table gives an empty result.
    """
    scores = zipf_scores(load_ranks(ranks_file))

    def begin():
        trie, split = ForwardTrie(scores), regex.compile(pattern)
        known: dict[str, int] = {}

        def scored(piece: str) -> int:
            if len(piece) > SHORT:
                return trie.count_long(piece.encode())
            if len(trie.best) > nodes:
                trie.clear()
            known[piece] = trie.count(piece.encode())
            return known[piece]

        def count(words: str) -> tuple[int, int]:
            many = total = 0
            for found in pre_tokens(split, words):
                if len(known) > KNOWN_PIECES:
                    known.clear()
                long = {piece: scored(piece) for piece in set(found).difference(known)}
                many += len(found)
                if any(len(piece) > SHORT for piece in long):
                    total += sum(known[x] if x in known else long[x] for x in found)
                else:
                    total += sum(map(known.__getitem__, found))
            return many, total

        return lambda texts: list(zip(*(count(words or "") for words in texts)))

    columns = {"n_pretokens": ("long", pa.int64()), "n_tokens": ("long", pa.int64())}
    return per_row(docs, [key], text, begin, columns)
