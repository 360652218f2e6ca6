"""Hard negatives for anchors by exact integer scores from packed products.

Components become integers.  For a product, the components of several candidates
are moved into the non-negative range and laid side by side into the fields of
one wide integer, so that one multiplication per component of an anchor serves
all of them; fields are wide enough for the whole sum, and nothing carries over.
Unpacking the fields and taking the shifts back out gives exact scores.  Wide
integers are whole numbers below 2^53 in double precision, which every addition
and multiplication keeps exact; scores that need more use Python's integers.

Anchors are a stated share of the rows and meet all rows in blocks: a block of
anchors has a fixed size and goes to all tasks, each of which reads its part of
the table as a stream and keeps the best few per anchor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.llm.common import checkpointed
from folioscope.llm.integers import matrix, scaled, usable

EXACT = 53
BLOCK = 16384  # anchors that go to all tasks at once
ANCHORS, CANDIDATES = 256, 4096  # scores held at a time
LEAST = np.iinfo(np.int64).min


class PackedProducts:
    """Scores of candidates with anchors, several candidates to a wide integer."""

    def __init__(self, candidates: np.ndarray):
        self.many, self.dims = candidates.shape
        self.shift = -min(0, int(candidates.min(initial=0)))
        self.moved = candidates + self.shift
        self.sums = candidates.sum(axis=1)
        self.largest = int(self.moved.max(initial=0))

    def _packed(self, width: int, fields: int, kind) -> np.ndarray:
        """Components by wide integer; candidate k lies in field k // (number of wide integers)."""
        wide = math.ceil(self.many / fields)
        filled = np.zeros((wide * fields, self.dims), dtype=kind)
        filled[: self.many] = self.moved.astype(kind)
        packed = filled[:wide]
        for k in range(1, fields):
            packed = packed + filled[k * wide : (k + 1) * wide] * (kind(1 << width * k) if kind is float else 1 << width * k)
        return packed.T

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products ``[anchor, candidate]``."""
        shift = -min(0, int(anchors.min(initial=0)))
        moved = anchors + shift
        width = max(1, (self.dims * self.largest * int(moved.max(initial=0))).bit_length())
        small = width <= EXACT
        fields = EXACT // width if small else 4
        kind = float if small else object
        product = moved.astype(kind) @ self._packed(width, fields, kind)
        if small:
            product = product.astype(np.int64)
        mask = (1 << width) - 1
        found = np.concatenate([product >> width * k & mask for k in range(fields)], axis=1)[:, : self.many]
        taken = self.shift * anchors.sum(axis=1)[:, None] + shift * self.sums[None, :]
        return (found - taken - self.dims * shift * self.shift).astype(np.int64)


class Best:
    """The best few ``(score, id)`` per place, higher scores and then smaller ids first."""

    def __init__(self, places: int, few: int):
        self.few = few
        self.bar = np.full(places, LEAST)  # what the last of a full list scores
        self.rows = [np.empty(0, dtype=np.int64)] * 4  # place, score, id, row

    def offer(self, first: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        """Scores of places from ``first`` on with candidates, where ``allowed``."""
        bar = self.bar[first : first + len(scores)]
        good = allowed & (scores >= bar[:, None])
        if scores.shape[1] > self.few and good.sum() > 4 * self.few * len(scores):
            seen = np.where(good, scores, LEAST)
            last = np.partition(seen, -self.few, axis=1)[:, -self.few]
            good &= scores >= last[:, None]
        place, which = np.nonzero(good)
        if not len(place):
            return
        new = (place + first, scores[place, which], ids[which], rows[which])
        every = [np.concatenate(both) for both in zip(self.rows, new)]
        order = np.lexsort((every[3], every[2], -every[1], every[0]))
        every = [column[order] for column in every]
        start = np.flatnonzero(np.diff(every[0], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
        self.rows = [column[rank < self.few] for column in every]
        full = rank == self.few - 1
        self.bar[every[0][full]] = every[1][full]


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple]:
    """Candidates of one length: vectors, ids, rows and labels."""
    for batch in batches:
        lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
        batch = batch.filter(pa.array(lengths == dims))
        for at in range(0, batch.num_rows, CANDIDATES):
            some = batch.slice(at, CANDIDATES)
            rest = [some.column(name).to_numpy(zero_copy_only=False) for name in ("id", "row", "label")]
            yield matrix(some.column("v"), dims), *rest


def _found(best: Best, anchor: np.ndarray) -> pa.RecordBatch:
    place, score, ids, rows = best.rows
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor[place]), pa.array(place), pa.array(ids), pa.array(rows), pa.array(score)],
        names=["anchor", "place", "id", "row", "score"],
    )


FOUND = "anchor long, place long, id long, row long, score long"


def _positives(store: DataFrame, anchors, few: int) -> DataFrame:
    """The best rows of each anchor's own label but itself; ``place`` is the anchor's in the block."""
    sent = store.sparkSession.sparkContext.broadcast(anchors)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, row, label = sent.value
        best = Best(len(v), few)
        for candidates, ids, rows, labels in _chunks(batches, v.shape[1]):
            packed = PackedProducts(candidates)
            for at in range(0, len(v), ANCHORS):
                part = slice(at, at + ANCHORS)
                own = (label[part, None] == labels) & (row[part, None] != rows)
                best.offer(at, packed.scores(v[part]), own, ids, rows)
        yield _found(best, row)

    return store.mapInArrow(search, FOUND)


def _negatives(store: DataFrame, anchors, bounds, few: int) -> DataFrame:
    """The best rows of other labels between an anchor's bounds, per pair; ``place`` is the pair's."""
    sent = store.sparkSession.sparkContext.broadcast((anchors, bounds))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (v, row, label), (of, low, high) = sent.value
        best = Best(len(of), few)
        for candidates, ids, rows, labels in _chunks(batches, v.shape[1]):
            packed = PackedProducts(candidates)
            for at in range(0, len(of), ANCHORS):
                pairs = slice(at, at + ANCHORS)
                used, back = np.unique(of[pairs], return_inverse=True)  # pairs are sorted by anchor
                scores = packed.scores(v[used])[back]
                other = label[of[pairs], None] != labels
                fits = (scores >= low[pairs, None]) & (scores <= high[pairs, None])
                best.offer(at, scores, other & fits, ids, rows)
        yield _found(best, row[of])

    return store.mapInArrow(search, FOUND)


def _first(found: DataFrame, few: int) -> DataFrame:
    order = W.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= few)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Each row for which ``is_anchor`` holds has as positives the ``positives`` other
    rows of its ``label`` with the highest scores, and per positive the
    ``negatives`` highest rows of another label that score from ``low`` to ``high``
    hundredths of the positive (with ties the smaller id first).  Rows whose id,
    label or vector is NULL or whose vector has a NULL or non-finite component
    take no part; vectors of different length do not meet.  Of rows that repeat
    an id each counts, as anchor, positive and negative, so result rows repeat.
    An anchor without positives or a pair without negatives has no rows; an
    empty table gives an empty result.
    """
    store = checkpointed(
        embeddings.select(
            F.col(key).cast("long").alias("id"),
            label.cast("long").alias("label"),
            scaled(vector, scale).alias("v"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
            usable(vector).alias("usable"),
        )
        .filter("usable AND id IS NOT NULL AND label IS NOT NULL")
        .select("id", "label", "v", "is_anchor", F.monotonically_increasing_id().alias("row"))
    )
    chosen = store.filter("is_anchor")
    sizes = chosen.groupBy(F.size("v").alias("dims")).count().collect()  # a row per length of vectors
    done = [store.limit(0).selectExpr(
        "id AS anchor_id", "id AS positive_id", "1 AS rank", "id AS negative_id",
        "id AS positive_score", "id AS negative_score",
    )]
    for dims, many in sorted(tuple(r) for r in sizes):
        blocks = math.ceil(many / block)
        for number in range(blocks):
            mine = chosen.filter(f"size(v) = {dims} AND pmod(xxhash64(row), {blocks}) = {number}")
            done.append(_block(store, mine.select("id", "row", "label", "v"), dims, positives, negatives, low, high))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def _block(store, mine, dims, positives, negatives, low, high) -> DataFrame:
    """Result rows of one block of anchors; the driver holds the block, its positives and their bounds."""
    held = mine.toArrow().combine_chunks()
    if not held.num_rows:
        v, row, label = np.empty((0, dims), dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    else:
        v = matrix(held.column("v").chunk(0), dims)
        row, label = held.column("row").to_numpy(), held.column("label").to_numpy()
    anchors = (v, row, label)
    near = _first(_positives(store, anchors, positives), positives).orderBy("place", "rank")
    pairs = near.select("place", "id", "score").toArrow()
    of, score = pairs.column("place").to_numpy(), pairs.column("score").to_numpy()
    bounds = (of, -(-low * score // 100), high * score // 100)
    found = checkpointed(_first(_negatives(store, anchors, bounds, negatives), negatives))
    named = pa.table(
        {
            "place": np.arange(len(of)),
            "anchor_id": held.column("id").to_numpy()[of] if held.num_rows else of,
            "positive_id": pairs.column("id"),
            "positive_score": pairs.column("score"),
        }
    )
    both = store.sparkSession.createDataFrame(named)
    return found.join(both, "place").selectExpr(
        "anchor_id", "positive_id", "rank", "id AS negative_id", "positive_score", "score AS negative_score"
    )
