"""Connected components over edge tables, and what rasters and meshes ask of them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geokernel.operators.tables import Rounds, dealt, written


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (child > parent)."""
    both = edges.select("child", "parent").union(edges.select(F.col("parent"), F.col("child"))).toDF("node", "other")
    lowest = both.groupBy("node").agg(F.min("other").alias("low"))
    lowest = lowest.select("node", F.least("node", "low").alias("low"))
    large = both.filter(F.col("other") > F.col("node")).join(lowest, "node").select(F.col("other").alias("node"), F.col("low").alias("other"))
    lowest = large.groupBy("node").agg(F.min("other").alias("low"))
    ends = F.array(F.struct(F.col("node").alias("child"), F.col("low").alias("parent")), F.struct(F.col("other").alias("child"), F.col("low").alias("parent")))
    return large.join(lowest, "node").select(F.inline(ends)).filter("child > parent").distinct()


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))).first())


def linked_roots(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the links; root is the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014). Links with a null end
    and self-links are ignored. A hot node is only ever on the wide side of an equi-join whose
    other side has one row a node, so adaptive execution can split it. Every round is written to
    the shared folder; only a count and a checksum reach the driver."""
    edges = links.select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent")).filter("child > parent").distinct()
    rounds = Rounds(links.sparkSession, "edges")
    edges = rounds.write(edges)
    seen = _print_of(edges)
    while seen[0]:
        edges = rounds.write(_stars(edges))
        now = _print_of(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("child").alias("node"), F.col("parent").alias("root"))
    return roots.union(edges.select("parent").distinct().select(F.col("parent").alias("node"), F.col("parent").alias("root")))


def components(nodes: DataFrame, edges: DataFrame, node: str = "id") -> DataFrame:
    """(id, component) for every node; component is the smallest id reachable over (a, b)."""
    roots = linked_roots(edges).withColumnRenamed("node", "id")
    return nodes.select(F.col(node).alias("id")).join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("component"))


#: Cells along a side of the tiles that are labelled by themselves.
TILE_CELLS = 512
#: A cell's id is r * _STRIDE + c.
_STRIDE = 1 << 31


def _lowest(n: int, i, j):
    """The smallest index of each one's connected piece, for links i - j."""
    import numpy as np

    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _label_tile(rows):
    import numpy as np
    import pyarrow as pa

    rows = rows.sort_by([("r", "ascending"), ("c", "ascending")])
    r, c = rows["r"].to_numpy(), rows["c"].to_numpy()
    ids = r * _STRIDE + c  # ascending
    links = []
    for step in (1, _STRIDE):
        at = np.minimum(np.searchsorted(ids, ids + step), len(ids) - 1)
        found = np.flatnonzero(ids[at] == ids + step)
        links.append((found, at[found]))
    low = _lowest(len(ids), *(np.concatenate([x[k] for x in links]) for k in (0, 1)))
    return pa.table({"r": r, "c": c, "label": ids[low]})


def raster_components(cells: DataFrame, tile: int = TILE_CELLS) -> DataFrame:
    """cells (r, c) with component: joined over the four neighbours; component is the smallest
    r * 2^31 + c of those that hang together.

    Tiles are labelled by themselves, a task each; only labels that touch across the borders of
    tiles are links between tasks, so a component of any size is a few links a tile."""
    r, c = F.col("r").cast("long"), F.col("c").cast("long")
    keyed = cells.select(r.alias("r"), c.alias("c")).distinct().withColumns({"ti": F.floor(F.col("r") / tile), "tj": F.floor(F.col("c") / tile)})
    labelled = written(keyed.groupBy("ti", "tj").applyInArrow(_label_tile, "r long, c long, label long"), "labels")
    links = None
    for along, across in (("r", "c"), ("c", "r")):
        last = labelled.filter(F.pmod(across, F.lit(tile)) == tile - 1).select(along, (F.col(across) + 1).alias(across), F.col("label").alias("a"))
        first = labelled.filter(F.pmod(across, F.lit(tile)) == 0).select(along, across, F.col("label").alias("b"))
        met = last.join(first, [along, across]).select("a", "b").distinct()
        links = met if links is None else links.union(met)
    roots = linked_roots(links).withColumnRenamed("node", "label")
    named = labelled.join(roots, "label", "left").select("r", "c", F.coalesce("root", "label").alias("component"))
    return cells.withColumns({"r": r, "c": c}).join(named, ["r", "c"])


def empty_components(filled: DataFrame, rows: int, cols: int) -> DataFrame:
    """(r, c, component) of the cells of a grid of rows x cols that are not filled."""
    spark = filled.sparkSession
    grid = spark.range(rows * cols).select(F.floor(F.col("id") / cols).cast("long").alias("r"), (F.col("id") % cols).alias("c"))
    return raster_components(grid.join(filled.select(F.col("r").cast("long"), F.col("c").cast("long")), ["r", "c"], "left_anti"))


def hole_sizes(empty: DataFrame, rows: int, cols: int) -> DataFrame:
    """(component, cells, interior) of empty_components: interior ones touch no border of the grid."""
    border = (F.col("r") == 0) | (F.col("c") == 0) | (F.col("r") == rows - 1) | (F.col("c") == cols - 1)
    return empty.groupBy("component").agg(F.count("*").alias("cells"), (F.max(border.cast("int")) == 0).alias("interior"))


def hole_report(filled: DataFrame, rows: int, cols: int) -> DataFrame:
    """One row: empty cells, holes that touch no border, their cells, and their share of the grid."""
    sizes = hole_sizes(empty_components(filled, rows, cols), rows, cols)
    inside = F.sum(F.when(F.col("interior"), F.col("cells")).otherwise(0))
    found = sizes.agg(F.coalesce(F.sum("cells"), F.lit(0)).alias("empty"), F.count_if("interior").alias("holes"), F.coalesce(inside, F.lit(0)).alias("inside"))
    return found.withColumn("share", F.col("inside") / float(rows * cols))


def interior_holes(filled: DataFrame, rows: int, cols: int, max_cells: int | None = None) -> DataFrame:
    """(r, c, component) of empty cells whose component touches no border and is small enough."""
    empty = written(empty_components(filled, rows, cols), "empty")
    inner = hole_sizes(empty, rows, cols).filter("interior")
    if max_cells is not None:
        inner = inner.filter(F.col("cells") <= max_cells)
    return empty.join(inner.select("component"), "component").select("r", "c", "component")


def fill_holes(filled: DataFrame, rows: int, cols: int, max_cells: int) -> DataFrame:
    """filled (r, c, v) and, for each small interior hole cell, the value of the nearest filled
    cell; of several nearest, the first by row and column."""
    from geokernel.operators.neighbours import nearest

    at = lambda df: df.select((F.col("r") * cols + F.col("c")).alias("id"), F.col("c").cast("double").alias("x"), F.col("r").cast("double").alias("y"))
    holes = interior_holes(filled, rows, cols, max_cells)
    near = nearest(at(holes), at(filled), axes=("x", "y"))
    source = filled.select((F.col("r") * cols + F.col("c")).alias("other"), "v")
    new = near.join(source, "other").select(F.floor(F.col("id") / cols).cast("long").alias("r"), (F.col("id") % cols).alias("c"), "v")
    return filled.select("r", "c", "v").union(new)


#: Points of a cell that travel together when cells are compared.
CELL_PIECE = 256


def proximity_components(points: DataFrame, radius: float) -> DataFrame:
    """(id, component) of points (id, x, y): joined by links up to the radius; component is the
    smallest id reachable.

    Cells are so narrow that the points of one hang together, so only cells are linked. Two cells
    are linked if some pair of their points is: points that are too far from the box around the
    other ones are left out first, and the first pair found ends the search."""
    width = radius / math.sqrt(2) * (1 - 1e-9)
    far2 = radius * radius
    keys = ["i", "j"]
    placed = " AND ".join(f"abs({a}) < double('infinity')" for a in "xy")
    keyed = points.select("id", "x", "y", *[F.when(F.expr(placed), F.floor(F.col(a) / width).cast("long")).alias(k) for a, k in zip("xy", keys, strict=True)])
    keyed = written(keyed, "keyed")
    held = keyed.filter("i IS NOT NULL")
    cells = written(held.groupBy(*keys).agg(F.min("id").alias("low"), F.count("*").alias("n")), "cells")
    dealt_out = held.join(cells, keys).withColumn("piece", F.pmod(F.xxhash64("x", "y"), F.ceil(F.col("n") / CELL_PIECE)))
    box = [f(a).alias(f"{n}{a}") for a in "xy" for n, f in (("lo", F.min), ("hi", F.max))]
    pieces = written(dealt_out.groupBy(*keys, "low", "piece").agg(F.collect_set(F.struct("x", "y")).alias("at"), *box).drop("piece"), "pieces")
    steps = [(i, j) for i in range(3) for j in range(-2, 3) if i > 0 or j > 0]
    beside = F.array(*[F.struct((F.col("i") + i).alias("i"), (F.col("j") + j).alias("j")) for i, j in steps])
    names = ["low", "at", "lox", "hix", "loy", "hiy"]
    one = pieces.select(*[F.col(c).alias(f"a_{c}") for c in names], F.inline(beside))
    both = one.join(dealt(pieces), keys)

    def reached(side: str, other: str):
        gap = lambda v, a: F.greatest(F.col(f"{other}lo{a}") - v, v - F.col(f"{other}hi{a}"), F.lit(0.0))
        return F.filter(f"{side}at", lambda p: gap(p["x"], "x") * gap(p["x"], "x") + gap(p["y"], "y") * gap(p["y"], "y") <= far2 * (1 + 1e-9))

    both = both.select("a_low", "low", reached("a_", "").alias("p"), reached("", "a_").alias("q"))
    d2 = lambda p, q: (p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"])
    linked = both.filter(F.exists("p", lambda p: F.exists("q", lambda q: d2(p, q) <= far2)))
    roots = linked_roots(linked.select(F.col("a_low").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "low")
    found = cells.join(roots, "low", "left").select(*keys, F.coalesce("root", "low").alias("component"))
    return keyed.join(found, keys, "left").select("id", F.coalesce("component", "id").alias("component"))


def is_connected(points: DataFrame, radius: float) -> bool:
    """Whether points (id, x, y) hang together over links up to the radius."""
    return proximity_components(points, radius).select("component").distinct().count() <= 1
