"""SimHash near-duplicates: a binary trie joined with itself.

Two nodes of the trie are walked together, the bits in which their paths differ
are added up, and a pair of nodes is left as soon as they exceed the budget.
The upper levels of the walk are a DataFrame job: each fingerprint is sent to
every pair of nodes (its own, another within the budget) at a depth that leaves
few fingerprints per node.  Pairs of nodes that are still large go deeper by
``STEP`` levels at a time.  The lower levels run inside tasks over sorted arrays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions.joins import salted_join
from folioscope.llm.common import checkpointed, per_row
from folioscope.llm.components import connected_components, join_labels, smallest_of_component

BITS = 64
STEP = 8
NODE = 8192  # fingerprints per node that the first depth aims at
LARGE = 8 * NODE  # a pair of nodes with more goes deeper
FRONT = 1 << 17  # pairs of nodes held at a time inside a task
WORDS_AT_ONCE = 1 << 15
SAME = 1024  # rows of one fingerprint that a task labels


def fingerprint(text: str | None, words: int, seed: int = 42) -> int:
    """SimHash over the hashes of all word shingles, as an unsigned integer.

    ASCII letters count as lower case; words end at blanks and \\t to \\r.  A
    text of fewer words is one shingle; without a word the result is 0.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    many = max(1, len(found) - words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, many, WORDS_AT_ONCE):
        part = found[at : min(many, at + WORDS_AT_ONCE) + words - 1]
        rows = zip(*(part[k:] for k in range(words))) if len(found) >= words else [found]
        hashes = np.array([digest(b" ".join(row), seed) for row in rows], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(ones * 2 > many, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``fp``, the fingerprint of each row as a signed long."""

    def begin():
        def step(texts: list) -> list:
            values = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
            return [values.view(np.int64)]

        return step

    return per_row(docs, keep, text, begin, {"fp": ("long", pa.int64())})


def _split(points: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """Where the right child begins in each node ``[low, high)`` at this bit."""
    keep = np.uint64(0) if bit == BITS - 1 else ~np.uint64((1 << (bit + 1)) - 1)
    first = (points[low] & keep) | np.uint64(1 << bit)
    return np.clip(np.searchsorted(points, first), low, high)


def trie_pairs(
    left: np.ndarray, right: np.ndarray | None, budget: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints within ``budget`` bits, in portions.

    ``left`` and ``right`` are sorted without repeats; without ``right``, pairs
    inside ``left``, each once.  Depth first over portions of the front, so the
    memory does not grow with the number of pairs.
    """
    inside = right is None
    other = left if inside else right
    if not len(left) or not len(other):
        return
    whole = np.array([[0, len(left), 0, len(other), 0]], dtype=np.int64)
    stack = [(BITS - 1, whole)]
    while stack:
        bit, front = stack.pop()
        if len(front) > FRONT:
            stack.append((bit, front[FRONT:]))
            front = front[:FRONT]
        a0, a1, b0, b1, used = front.T
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            near = np.bitwise_count(left[i] ^ other[j]) <= budget
            if inside:
                near &= i != j
            if near.any():
                yield i[near], j[near]
            a0, a1, b0, b1, used = front[~single].T
        if bit < 0 or not len(a0):
            continue
        am, bm = _split(left, a0, a1, bit), _split(other, b0, b1, bit)
        children = [
            np.stack((a0, am, b0, bm, used), axis=1),
            np.stack((am, a1, bm, b1, used), axis=1),
            np.stack((a0, am, bm, b1, used + 1), axis=1),
        ]
        mirrored = np.stack((am, a1, b0, bm, used + 1), axis=1)
        children.append(mirrored[a0 != b0] if inside else mirrored)
        below = np.concatenate(children)
        alive = (below[:, 0] < below[:, 1]) & (below[:, 2] < below[:, 3]) & (below[:, 4] <= budget)
        stack.append((bit - 1, below[alive]))


def _walk(group: pd.DataFrame, budget: int) -> pd.DataFrame:
    """A spanning forest of the links between the two nodes of one group."""
    points = group["fp"].to_numpy(np.int64).view(np.uint64)
    node = group["node"].to_numpy()
    order = np.argsort(points)
    points, ids, node = points[order], group["id"].to_numpy()[order], node[order]
    first, second = int(group["a"].iloc[0]), int(group["b"].iloc[0])
    label = np.arange(len(points))
    if first == second:
        for i, j in trie_pairs(points, None, budget):
            join_labels(label, i, j)
    else:
        left, right = np.flatnonzero(node == first), np.flatnonzero(node == second)
        for i, j in trie_pairs(points[left], points[right], budget):
            join_labels(label, left[i], right[j])
    linked = label != np.arange(len(points))
    return pd.DataFrame({"a": ids[linked], "b": ids[label[linked]]})


def _masks(width: int, budget: int) -> list[int]:
    """All words of ``width`` bits with at most ``budget`` ones."""
    return [
        sum(1 << k for k in ones)
        for many in range(min(budget, width) + 1)
        for ones in combinations(range(width), many)
    ]


def _node(depth: int) -> str:
    return "0L" if depth == 0 else f"shiftrightunsigned(fp, {BITS - depth})"


def _deeper(state: DataFrame, depth: int, step: int, budget: int) -> DataFrame:
    """Each fingerprint in each pair of nodes, sent on to the children within the budget."""
    masks = ", ".join(f"{m}L" for m in _masks(step, budget))
    return (
        state.withColumn("mask", F.expr(f"explode(array({masks}))"))
        .withColumn("used", F.expr("used + bit_count(mask)"))
        .filter(f"used <= {budget}")
        .selectExpr(
            "fp",
            "id",
            "used",
            f"{_node(depth + step)} AS node",
            f"(shiftleft(other, {step}) | ({_node(depth + step)} & {(1 << step) - 1}L)) ^ mask"
            " AS other",
        )
    )


def near_links(points: DataFrame, budget: int, node: int = NODE, large: int = LARGE) -> DataFrame:
    """Edges ``(a, b)`` that connect all ids whose ``fp`` differ in at most ``budget`` bits.

    ``points (id, fp)`` has one row per fingerprint and is read several times.
    The edges are a spanning forest of each task's links: fewer than its rows,
    however many pairs a dense group has.
    """
    many = points.count()
    depth = min(24, max(0, math.ceil(math.log2(max(many, 1) / node))))
    state = _deeper(points.selectExpr("fp", "id", "0 AS used", "0L AS other"), 0, depth, budget)

    def traverse(group: pd.DataFrame) -> pd.DataFrame:
        return _walk(group, budget)

    def edges(rows: DataFrame) -> DataFrame:
        return rows.groupBy("a", "b").applyInPandas(traverse, "a long, b long")

    result = None
    while True:
        paired = state.selectExpr(
            "fp", "id", "used", "node", "other", "least(node, other) AS a", "greatest(node, other) AS b"
        )
        crowded = paired.groupBy("a", "b").count().filter(f"count > {large}").select("a", "b")
        if depth + STEP > BITS:
            found, rest = edges(paired), None
        else:
            crowded = checkpointed(crowded)
            if crowded.isEmpty():
                found, rest = edges(paired), None
            else:
                found = edges(paired.join(crowded, ["a", "b"], "left_anti"))
                rest = paired.join(crowded, ["a", "b"], "left_semi")
        result = found if result is None else result.union(found)
        if rest is None:
            return result
        state = checkpointed(_deeper(rest.select("fp", "id", "used", "other"), depth, STEP, budget))
        depth += STEP


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    distance: int = 2,
    key: str = "doc_id",
    text: str = "text",
    node: int = NODE,
    large: int = LARGE,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id, text_hash, class)`` for every row of ``docs``.

    Fingerprints link at ``distance`` differing bits or fewer; ``class`` is the
    smallest fingerprint reachable, as a signed long, and the component is the
    smallest id of the class.  Classes may share that id if rows repeat it, so rows
    are grouped by class.  A NULL text counts as empty: fingerprint zero, linked
    like any other.  Rows that repeat an id get a row each.  A row without id links
    like any other; a class of such rows only has a NULL component.  An empty table
    gives an empty result.  ``text_hash`` is ``xxhash64`` of the text as it stands,
    to find the row again.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text")
    )
    marked = checkpointed(fingerprints(rows, words, ["id", "h"]))
    points = checkpointed(marked.groupBy("fp").agg(F.min("id").alias("id")))
    nodes = points.selectExpr("fp", "fp AS id")
    groups = connected_components(near_links(nodes, distance, node, large))
    named = smallest_of_component(groups, points.selectExpr("fp AS node", "id"))
    classes = points.join(named, points["fp"] == named["node"], "left").selectExpr(
        "fp", "coalesce(component, fp) AS class", "coalesce(label, id) AS component_id"
    )
    return salted_join(marked, classes, "fp", ["id", "h"], SAME).selectExpr(
        f"id AS {key}",
        "lpad(lower(hex(fp)), 16, '0') AS fingerprint",
        "component_id",
        "h AS text_hash",
        "class",
    )
