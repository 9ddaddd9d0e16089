"""Links between vectors at a cosine threshold, by dual traversal of cover trees.

On unit vectors a cosine threshold is a distance threshold. Vectors that are equal are one
entry with a number of copies. The upper level is made by Spark: the entries of a label go to
the nearest of its centers (cells, large ones in parts), and an entry meets another cell only
if its distance to that center is within the cell's covering radius plus the threshold. The
lower levels are made in the task that compares two cells: nested nets, each with half the
radius of the one above. Pairs of nodes are traversed from the roots: pairs further apart than
their radii and the threshold allow are pruned, pairs that are wholly within it are counted
without being listed, and leaves are compared exactly. A task returns a count of links and a
local root per entry, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entityfold.llm.common import connected_components, least_reachable, materialise

CELL = 2048
MAX_CENTERS = 512
LEAF = 64
NET = 32
SLACK = 1e-9
FAR = np.int64(1) << 62


def unit_rows(vectors: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _distance(rows: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - center) ** 2).sum(axis=1))


class Node:
    """Points ``index`` around ``center``; no point is further than ``radius``."""

    __slots__ = ("center", "index", "parts", "radius")

    def __init__(self, rows: np.ndarray, index: np.ndarray):
        self.center, self.index, self.parts = rows[index[0]], index, []
        away = _distance(rows[index], self.center)
        self.radius = float(away.max())
        if len(index) <= LEAF or self.radius <= SLACK:
            return
        left, nets = index, []
        while len(left) and len(nets) < NET:  # the first center is the parent's: the nets are nested
            near = _distance(rows[left], rows[left[0]]) <= self.radius / 2
            nets.append(left[near])
            left = left[~near]
        if 2 * len(left) <= len(index):  # else the points lie too far apart for a net to help
            self.parts = [Node(rows, net) for net in nets]
            if len(left):
                self.parts.append(Node(rows, left))


class Links:
    """Counts and local roots of entries 0 to n-1 (those of both sides)."""

    def __init__(self, rows: np.ndarray, copies: np.ndarray, threshold: float):
        self.rows, self.copies, self.threshold = rows, copies, threshold
        self.reach = float(np.sqrt(2 - 2 * threshold))
        self.count = np.zeros(len(rows), np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def traverse(self, a: Node, b: Node) -> None:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            apart = 0.0 if a is b else float(np.sqrt(((a.center - b.center) ** 2).sum()))
            if apart > a.radius + b.radius + self.reach + SLACK:
                continue
            if apart + a.radius + b.radius <= self.reach - SLACK:
                self._all(a.index, b.index, a is b)
            elif not a.parts and not b.parts:
                self._compare(a.index, b.index, a is b)
            elif a is b:
                stack += [(p, q) for i, p in enumerate(a.parts) for q in a.parts[i:]]
            elif a.parts and (a.radius >= b.radius or not b.parts):
                stack += [(p, b) for p in a.parts]
            else:
                stack += [(a, p) for p in b.parts]

    def _all(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        self.count[a] += self.copies[b].sum()
        if same:
            self.count[a] -= self.copies[a]
        else:
            self.count[b] += self.copies[a].sum()
        every = np.concatenate([a, b])
        self.edges.append((every, np.full(len(every), every.min())))

    def _compare(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        near = self.rows[a] @ self.rows[b].T >= self.threshold
        if same:
            np.fill_diagonal(near, False)
        if not near.any():
            return
        self.count[a] += near @ self.copies[b]
        if not same:
            self.count[b] += near.T @ self.copies[a]
        i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        a, b, near = a[i], b[j], near[np.ix_(i, j)]
        root_a, root_b = a.copy(), b.copy()
        while True:
            new_a = np.minimum(root_a, np.where(near, root_b[None, :], FAR).min(axis=1))
            new_b = np.minimum(root_b, np.where(near, new_a[:, None], FAR).min(axis=0))
            if (new_a == root_a).all() and (new_b == root_b).all():
                break
            root_a, root_b = new_a, new_b
        self.edges += [(a, root_a), (b, root_b)]


def compare_cells(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """One pair of cells (or a cell with itself): links and local root per entry."""
    group = group.sort_values("node", ignore_index=True)
    links = Links(unit_rows(group["embedding"]), group["copies"].to_numpy(np.int64), threshold)
    left = np.flatnonzero((group["unit"] == group["x"]).to_numpy())
    right = np.flatnonzero((group["unit"] == group["y"]).to_numpy())
    if group["x"].iloc[0] == group["y"].iloc[0]:
        root = Node(links.rows, left)
        links.traverse(root, root)
    elif len(left) and len(right):
        links.traverse(Node(links.rows, left), Node(links.rows, right))
    a, b = (np.concatenate([e[k] for e in links.edges] or [np.empty(0, np.int64)]) for k in (0, 1))
    roots = least_reachable(len(group), a, b)
    out = pd.DataFrame({"node": group["node"], "links": links.count, "root": group["node"].to_numpy()[roots]})
    return out[links.count > 0]


def _nearest(rows: pd.DataFrame, centers: pd.DataFrame) -> pd.DataFrame:
    points, centers = unit_rows(rows["embedding"]), centers.sort_values("cell", ignore_index=True)
    away = _between(points, unit_rows(centers["center"]))
    best = away.argmin(axis=1)
    return pd.DataFrame({"node": rows["node"], "cell": centers["cell"].to_numpy()[best], "away": away[np.arange(len(rows)), best]})


def _between(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (points @ centers.T)))


def _meetings(rows: pd.DataFrame, cells: pd.DataFrame, reach: float) -> pd.DataFrame:
    """For each entry the pairs of units in which it must be compared; its own unit is ``unit``."""
    points = unit_rows(rows["embedding"])
    near = _between(points, unit_rows(cells["center"])) <= cells["radius"].to_numpy()[None, :] + reach + 1e-6
    near |= rows["cell"].to_numpy()[:, None] == cells["cell"].to_numpy()[None, :]
    i, j = np.nonzero(near)
    parts = cells["parts"].to_numpy()[j]
    k = np.repeat(np.arange(len(i)), parts)
    part = np.arange(len(k)) - np.repeat(np.cumsum(parts) - parts, parts)
    other = cells["cell"].to_numpy()[j][k] * (1 << 32) + part
    own = rows["unit"].to_numpy()[i][k]
    return pd.DataFrame({"row": i[k], "x": np.minimum(own, other), "y": np.maximum(own, other), "unit": own})


def vector_links(
    df: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """Per vector its key, ``n_links``, ``component_id`` and ``kept``.

    Vectors are compared when their labels are equal and not null and they have one length.
    Null, empty and zero vectors, vectors with a null or non-finite component, and vectors with
    a null key link with nothing; a null key has a null component and is not kept. Equal rows
    are vectors of their own and link with one another. Other columns are not read.
    """
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))
    usable &= F.col(key).isNotNull() & F.col(label).isNotNull()
    half = [F.hex(F.xxhash64(*lead, label, vector)) for lead in ((), (F.lit(1),))]
    node = F.when(usable, F.concat(*(F.lpad(h, 16, "0") for h in half)))
    rows = materialise(
        df.select(
            F.col(key).alias("key"), F.col(label).cast("string").alias("label"), F.when(usable, F.col(vector)).alias("embedding"), node.alias("node")
        ),
        "vectors",
    )
    group = ["label", "size"]
    entries = (
        rows.where("node is not null").groupBy("node", "label", "embedding").agg(F.count("*").alias("copies"), F.min("key").alias("first"))
        .withColumn("size", F.size("embedding"))
    )
    entries = materialise(entries, "entries")
    sizes = entries.groupBy(*group).count().select(
        *group, F.ceil(F.col("count") / CELL).alias("salts"), F.least(F.ceil(F.col("count") / (CELL // 2)), F.lit(MAX_CENTERS)).alias("wanted")
    )
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64("node"), "node"))
    centers = entries.select(*group, "node", F.col("embedding").alias("center")).withColumn("cell", rank.cast("long")).where(F.col("cell") <= MAX_CENTERS)
    centers = materialise(centers.join(sizes, group).where("cell <= wanted").drop("node", "wanted"), "centers")
    salt = F.pmod(F.xxhash64("node", F.lit(3)), "salts")
    salted = materialise(entries.join(sizes.drop("wanted"), group).withColumn("salt", salt).drop("salts"), "salted")

    def everywhere(cells: DataFrame) -> DataFrame:
        return cells.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")

    dealt = [*group, "salt"]
    nearest = salted.select(*dealt, "node", "embedding").groupBy(*dealt).cogroup(everywhere(centers).groupBy(*dealt)).applyInPandas(
        _nearest, "node string, cell long, away double"
    )
    nearest = materialise(nearest, "nearest")
    placed = salted.join(nearest, "node")
    radii = placed.groupBy(*group, "cell").agg(F.max("away").alias("radius"), F.ceil(F.count("*") / CELL).alias("parts"))
    cells = materialise(centers.join(radii, [*group, "cell"]), "cells")
    part = F.pmod(F.xxhash64("node", F.lit(5)), "parts")
    placed = placed.join(cells.select(*group, "cell", "parts"), [*group, "cell"]).withColumn("unit", F.col("cell") * (1 << 32) + part)
    reach = float(np.sqrt(2 - 2 * threshold))

    def meet(points: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        met = _meetings(points, near, reach)
        at = met["row"].to_numpy()
        return met.drop(columns="row").assign(**{c: points[c].to_numpy()[at] for c in ("label", "size", "node", "copies", "embedding")})

    kind = entries.schema["embedding"].dataType.simpleString()
    met = placed.select(*dealt, "node", "copies", "embedding", "cell", "unit").groupBy(*dealt).cogroup(everywhere(cells).groupBy(*dealt)).applyInPandas(
        meet, f"x long, y long, unit long, label string, size int, node string, copies long, embedding {kind}"
    )
    found = met.groupBy(*group, "x", "y").applyInPandas(lambda g: compare_cells(g, threshold), "node string, links long, root string")
    found = materialise(found, "links")
    groups = materialise(connected_components(found, "node", "root"), "groups")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = entries.select("node", "copies", "first").join(counts, "node", "left").join(groups, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    # A table of its own, so that the join deals out both sides anew and can split a large component.
    least = materialise(named.groupBy("component").agg(F.min("first").alias("least")), "names")
    named = named.join(least, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("least").alias("component_id")
    )
    out = rows.select("key", "node").join(named, "node", "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "key").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
