"""Documents packed into sequences of fixed size, planned on a histogram of lengths.

Best fit, longest first, over counts: pieces of one length are interchangeable,
so bins that have the same space left are filled as one group.  The plan has a
row per group and length, however many documents there are.  Pieces then get a
rank within their length and take the planned place of that rank.

Ranks are counted in two steps, within a hashed cell of a length and over the
cells before it, so a length that most documents share is spread over tasks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.llm.common import checkpointed, per_row
from folioscope.llm.vocabulary import load_ranks

SIZE = 2048
CELLS = 256
LONG = 1 << 16  # runs of white space from this length on do not meet PATTERN, which backtracks over them
RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def plan_best_fit(counts: dict[int, int], size: int) -> list[tuple]:
    """``(length, first, last, per_bin, bin, offset)``: pieces of this length with ranks ``first`` to
    ``last - 1`` go to the bins from ``bin`` on, ``per_bin`` in each, the first at ``offset``."""
    open_bins: dict[int, list[tuple[int, int]]] = {}  # space left: (first bin, bins)
    plan, bins = [], 0
    for length in sorted(counts, reverse=True):
        first, todo = 0, counts[length]

        def fill(start: int, many: int, space: int) -> int:
            """Fill up to ``many`` equal bins; bins touched."""
            nonlocal first, todo
            per = space // length
            whole = min(many, todo // per)
            if whole:
                plan.append((length, first, first + whole * per, per, start, size - space))
                first, todo = first + whole * per, todo - whole * per
                if space > per * length:
                    open_bins.setdefault(space - per * length, []).append((start, whole))
            if whole < many and todo:
                plan.append((length, first, first + todo, todo, start + whole, size - space))
                rest = space - todo * length
                open_bins.setdefault(rest, []).append((start + whole, 1))
                first, todo, whole = first + todo, 0, whole + 1
            return whole

        for space in sorted(s for s in open_bins if s >= length):
            groups = open_bins.pop(space)
            while groups and todo:
                start, many = groups.pop()
                used = fill(start, many, space)
                if used < many:
                    groups.append((start + used, many - used))
            if groups:
                open_bins.setdefault(space, []).extend(groups)
            if not todo:
                break
        if todo:
            per = size // length
            fresh = -(-todo // per)
            start, bins = bins, bins + fresh
            fill(start, fresh, size)
    return plan


def _plan_table(spark: SparkSession, plan: list[tuple]) -> DataFrame:
    rows = "array<struct<a:int,b:bigint,c:bigint,d:bigint,e:bigint,f:int>>"
    text = json.dumps([dict(zip("abcdef", row)) for row in plan])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), rows))).toDF(
        "of_length", "first", "last", "per_bin", "bin", "base"
    )


def best_fit(
    pieces: DataFrame, order: list[str], size: int = SIZE, length: str = "length", cells: int = CELLS
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; lengths from 1 to ``size``.

    ``order`` names columns that tell pieces apart; pieces equal in all of them
    are interchangeable.  ``pieces`` is read several times, so it should be stored.
    """
    spread = pieces.withColumn("cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    per_cell = checkpointed(spread.groupBy(length, "cell").count())
    histogram = per_cell.groupBy(length).agg(F.sum("count").alias("n")).collect()  # at most `size` rows
    counts = {row[length]: row["n"] for row in histogram}
    if counts and (min(counts) < 1 or max(counts) > size):
        raise ValueError(f"lengths must be from 1 to {size}")
    earlier = W.partitionBy(length).orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_cell.select(
        length, "cell", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")
    )
    plan = _plan_table(pieces.sparkSession, plan_best_fit(counts, size))
    within = F.row_number().over(W.partitionBy(length, "cell").orderBy(*order)) - 1
    ranked = (
        spread.withColumn("within", within)
        .join(offsets, [length, "cell"])
        .withColumn("rank", F.col("within") + F.col("before"))
    )
    # The plan grows with the distinct lengths, not with the pieces.
    placed = ranked.join(
        F.broadcast(plan),
        (ranked[length] == plan["of_length"]) & F.col("rank").between(plan["first"], plan["last"] - 1),
    )
    turn = F.col("rank") - F.col("first")
    return placed.select(
        *pieces.columns,
        (F.col("bin") + F.floor(turn / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("base") + turn % F.col("per_bin") * F.col(length)).cast("long").alias("offset"),
    )


def encoder(ranks: dict[bytes, int], specials: dict[str, int]) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids.

    A long run of white space is a match of ``PATTERN`` by itself: all of it before
    a special token or the end, else all but the last character.
    """
    codec = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=specials)
    whole = tiktoken.Encoding("runs", pat_str=r"\s+", mergeable_ranks=ranks, special_tokens={})

    def encode(words: str) -> np.ndarray:
        parts, at = [], 0
        for run in RUN.finditer(words) if len(words) >= LONG else ():
            last = run.end()
            if last < len(words) and not any(words.startswith(token, last) for token in specials):
                last -= 1
            parts.append(codec.encode_to_numpy(words[at : run.start()], allowed_special="all"))
            parts.append(whole.encode_to_numpy(words[run.start() : last], allowed_special="all"))
            at = last
        parts.append(codec.encode_to_numpy(words[at:] if at else words, allowed_special="all"))
        return np.concatenate(parts).astype("<u4")

    return encode


def token_pieces(
    docs: DataFrame,
    ranks_file: str,
    size: int = SIZE,
    end: int = 0,
    specials: dict[str, int] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, tokens)``: each text's ids and ``end``, in pieces.

    Only longer ones are cut, from the end, into pieces of ``size`` ids, so the
    first may be shorter.  ``tokens`` holds unsigned 32-bit little-endian ids.  A NULL text
    counts as empty and gives one piece with ``end``.
    """
    ranks, extra = load_ranks(ranks_file), dict(specials or {})

    def begin():
        encode = encoder(ranks, extra)

        def cut(words: str | None) -> list[dict]:
            ids = np.append(encode(words or ""), np.array([end], dtype="<u4"))
            edges = [0, *range((len(ids) - 1) % size + 1, len(ids) + 1, size)]
            return [
                {"piece": k, "start": lo, "length": hi - lo, "tokens": ids[lo:hi].tobytes()}
                for k, (lo, hi) in enumerate(zip(edges, edges[1:]))
            ]

        return lambda texts: [[cut(words) for words in texts]]

    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("tokens", pa.binary())]
    kind = "array<struct<piece:int, start:bigint, length:bigint, tokens:binary>>"
    cut = per_row(docs, [key], text, begin, {"pieces": (kind, pa.list_(pa.struct(fields)))})
    return cut.select(key, F.inline("pieces"))


def pack_documents(
    docs: DataFrame,
    ranks_file: str,
    size: int = SIZE,
    end: int = 0,
    specials: dict[str, int] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Where each piece of each document goes.

    ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``.  NULL and
    empty texts are one piece with the end id alone; rows that repeat an id are
    documents of their own; an empty table gives an empty result.
    """
    cut = token_pieces(docs, ranks_file, size, end, specials, key, text)
    pieces = checkpointed(
        cut.select(key, "piece", "start", "length", F.crc32("tokens").alias("ids_crc32"))
    )
    return best_fit(pieces, [key, "piece", "ids_crc32"], size)
