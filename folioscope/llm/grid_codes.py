"""Vector codes from codebooks per part, found through memoised grid cells.

A vector is cut into parts, and each part is written as the number of the
nearest entry of that position's codebook.  Space around the entries is a grid:
all points of a cell lie in one box, and an entry whose least distance to the
box exceeds another entry's greatest distance to it is nearest to no point of
the cell.  What is left after that is worked out once per cell and remembered
under the hash of the cell's coordinates; a point is then compared only with the
entries its cell has kept.  All distances are exact integers.

Codebooks are learned by rounds of assignment and averaging.  A round is one
pass over the vectors; tasks give back one sum per entry, so what travels and
what the driver holds depends on the size of the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import checkpointed
from folioscope.llm.integers import matrix, scaled, usable

CELLS = 1 << 15  # remembered per part before the memory is begun anew
ROWS_AT_ONCE = 4096
FAR = np.iinfo(np.int64).max


class GridCells:
    """The codebook of one part position and what its grid cells remember.

    The cells' width is the power of two next below an eighth of the entries'
    spread; it decides the time only.
    """

    def __init__(self, entries: np.ndarray, cells: int = CELLS):
        self.entries, self.limit = entries, cells
        spread = int(np.ptp(entries, axis=0).max()) if len(entries) else 0
        self.shift = max(1, spread // 8).bit_length() - 1
        odd = np.random.default_rng(entries.shape[1]).integers(1 << 62, size=entries.shape[1], dtype=np.uint64)
        self.mixing = odd * np.uint64(2) + np.uint64(1)
        self._forget()

    def _forget(self) -> None:
        self.names = np.empty(0, dtype=np.uint64)
        self.cells = np.empty((0, self.entries.shape[1]), dtype=np.int64)
        self.kept = np.empty((0, len(self.entries)), dtype=bool)

    def _undominated(self, cells: np.ndarray) -> np.ndarray:
        """For each cell the entries that may be nearest to a point of it."""
        low = (cells << self.shift)[:, None, :]
        high = low + (1 << self.shift) - 1
        least = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
        most = np.maximum(np.abs(self.entries - low), np.abs(self.entries - high))
        bound = (most * most).sum(axis=2).min(axis=1, keepdims=True)
        return (least * least).sum(axis=2) <= bound

    def _remember(self, names: np.ndarray, cells: np.ndarray) -> None:
        if len(self.names) + len(names) > self.limit:
            self._forget()
        every = np.concatenate((self.names, names))
        order = np.argsort(every, kind="stable")
        self.names = every[order]
        self.cells = np.concatenate((self.cells, cells))[order]
        self.kept = np.concatenate((self.kept, self._undominated(cells)))[order]

    def _candidates(self, points: np.ndarray) -> np.ndarray:
        cells = points >> self.shift
        names = (cells.astype(np.uint64) * self.mixing).sum(axis=1, dtype=np.uint64)
        here, first, of = np.unique(names, return_index=True, return_inverse=True)
        known = np.isin(here, self.names, assume_unique=True)
        if not known.all() and len(here) - known.sum() + len(self.names) > self.limit:
            self._forget()
            known[:] = False
        if not known.all():
            self._remember(here[~known], cells[first[~known]])
        row = np.searchsorted(self.names, here)[of]
        kept = self.kept[row]
        kept[(self.cells[row] != cells).any(axis=1)] = True  # two cells under one hash
        return kept

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry (of equally near ones the first) and squared distance per point."""
        point, entry = np.nonzero(self._candidates(points))
        apart = points[point] - self.entries[entry]
        distance = np.full((len(points), len(self.entries)), FAR)
        distance[point, entry] = (apart * apart).sum(axis=1)
        best = distance.argmin(axis=1)
        return best, distance[np.arange(len(points)), best]


def _parts(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple]:
    """Per slice of a batch: the slice, its vectors by part, entries and distances by part."""
    parts, _, width = books.shape
    grids = [GridCells(book) for book in books]
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            some = batch.slice(at, ROWS_AT_ONCE)
            points = matrix(some.column("v"), parts * width).reshape(-1, parts, width)
            found = [grid.nearest(points[:, k]) for k, grid in enumerate(grids)]
            yield some, points, np.stack([f[0] for f in found]), np.stack([f[1] for f in found])


def _averaged(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: floors of means, unused entries as they were."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for _, points, nearest, _ in _parts(batches, books):
            for k in range(parts):
                np.add.at(total[k, :, :width], nearest[k], points[:, k])
                total[k, :, width] += np.bincount(nearest[k], minlength=entries)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel()[place])], names=["place", "total"])

    sums = vectors.select("v").mapInArrow(add, "place long, total long")
    rows = sums.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = np.zeros(parts * entries * (width + 1), dtype=object)
    for row in rows:
        total[row["place"]] = int(row["total"])
    total = total.reshape(parts, entries, width + 1)
    used = total[:, :, width:] > 0
    return np.where(used, total[:, :, :width] // np.where(used, total[:, :, width:], 1), books).astype(np.int64)


def encode_vectors(
    embeddings: DataFrame,
    scale: int = 4096,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable vectors, and the codebooks ``[part, entry, component]``.

    The frame is ``(key, label, code, error)``: two hexadecimal digits per part
    (``entries`` is 256 at most) and the squared distances added up.  Codebooks
    begin with the vectors of the ``entries`` smallest ids (of vectors under one
    id the smallest; fewer ids, fewer entries).  Left out are vectors that are
    NULL, hold NULL or non-finite components, or whose length is not that of
    the smallest id's vector or no positive multiple of ``parts``.  Rows without
    id are encoded but begin no entry; if no row has an id, code and error are
    NULL.  Repeated rows count and stay.  An empty table gives an empty result
    and no codebooks.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits per part")
    fit = embeddings.filter(usable(vector) & F.expr(f"size({vector}) > 0 AND size({vector}) % {parts} = 0"))
    # Plain names of our own, so that no further column can clash.
    whole = checkpointed(
        fit.select(F.col(key).alias("id"), F.col(label).alias("label"), scaled(vector, scale).alias("v"))
    )
    names = (key, label)
    ids = [r["id"] for r in whole.select("id").filter("id IS NOT NULL").distinct().orderBy("id").limit(entries).collect()]
    seeds = whole.filter(F.col("id").isin(ids)).groupBy("id").agg(F.min("v").alias("v")).orderBy("id")
    first = [r["v"] for r in seeds.collect()] if ids else []
    first = [v for v in first if len(v) == len(first[0])]
    if not first:
        none = whole.select(
            F.col("id").alias(key), F.col("label").alias(label),
            F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"),
        )
        return none, np.empty((parts, 0, 0), dtype=np.int64)
    dims = len(first[0])
    vectors = whole.filter(f"size(v) = {dims}")
    books = np.array(first, dtype=np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _averaged(vectors, books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, _, nearest, distance in _parts(batches, books):
            code = [bytes(row).hex() for row in nearest.T.astype(np.uint8)]
            columns = [some.column("id"), some.column("label"), pa.array(code), pa.array(distance.sum(axis=0))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    kinds = dict(vectors.dtypes)
    coded = vectors.mapInArrow(encode, f"id {kinds['id']}, label {kinds['label']}, code string, error long")
    return coded.toDF(*names, "code", "error"), books


def digest(books: np.ndarray) -> str:
    """Hash of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """Add ``label_error``: the errors of all rows with an equal label, NULL ones together.

    NULL if the sum exceeds 63 bits.  Sums are pre-aggregated; the join brings back
    one row per label.
    """
    kept = checkpointed(coded)
    sums = kept.groupBy(F.col(label).alias("__label")).agg(F.try_sum("error").alias("label_error"))
    return kept.join(sums, F.col(label).eqNullSafe(F.col("__label"))).drop("__label")
