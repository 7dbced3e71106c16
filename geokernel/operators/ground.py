"""Ground points of a cloud: outliers by their neighbours, then progressive opening of the lowest
surface, its slope, and each point beside it (Pingel et al., 2013)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geokernel.operators.grid import focal
from geokernel.operators.neighbours import nearest
from geokernel.operators.tables import Rounds, written

#: Class codes of ground, noise, and points that are neither.
GROUND, NOISE, OTHER = 2, 7, 1
#: Neighbours of a point, and deviations above the mean beyond which it is an outlier.
NEIGHBOURS, DEVIATIONS = 8, 2.0
#: Rise over run of natural ground, metres of slack, and what steep ground adds to it.
SLOPE, SLACK, SCALAR = 0.15, 0.5, 1.25
#: Radii, in cells, of the windows that open the surface one after the other.
WINDOWS = (1, 2, 4, 8, 16)


def outliers(points: DataFrame, k: int = NEIGHBOURS, deviations: float = DEVIATIONS) -> DataFrame:
    """(id, mean, outlier): the mean distance of each point (id, x, y, z) to its k nearest others,
    and whether it exceeds the mean of all by so many standard deviations.

    A point without neighbours is an outlier; with one point there is none."""
    near = nearest(points, points, k=k, exclude_self=True).groupBy("id").agg(F.avg(F.sqrt("d2")).alias("mean"))
    near = written(points.select("id").join(near, "id", "left"), "distances")
    mean, spread = near.agg(F.avg("mean"), F.stddev_samp("mean")).first()
    if mean is None:
        return near.withColumn("outlier", F.lit(False))
    return near.withColumn("outlier", F.coalesce(F.col("mean") > mean + deviations * (spread or 0.0), F.lit(True)))


def lowest_surface(points: DataFrame, gsd: float) -> DataFrame:
    """(r, c, v): the lowest point of each cell."""
    return points.groupBy(F.floor(F.col("y") / gsd).alias("r"), F.floor(F.col("x") / gsd).alias("c")).agg(F.min("z").alias("v"))


def opened_cells(surface: DataFrame, gsd: float, slope: float = SLOPE, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """(r, c, v, object): cells of the lowest surface, and whether opening by some window lowers
    what the window before has left by more than the slope over its radius."""
    steps = Rounds(surface.sparkSession, "openings")
    now = steps.write(surface.select("r", "c", "v", F.col("v").alias("left"), F.lit(False).alias("object")))
    for radius in windows:
        eroded = focal(now.select("r", "c", F.col("left").alias("v")), radius, "min")
        opened = focal(eroded, radius, "max").withColumnRenamed("v", "opened")
        raised = F.col("left") - F.col("opened") > slope * radius * gsd
        now = steps.write(now.join(opened, ["r", "c"]).select("r", "c", "v", F.col("opened").alias("left"), (F.col("object") | raised).alias("object")))
    return now.select("r", "c", "v", "object")


def ground_surface(cells: DataFrame, gsd: float) -> DataFrame:
    """(r, c, v, steep): the surface of the cells that are no objects, those of objects by the
    nearest of them, and its slope by the neighbours that there are."""
    # Ids go by rows and columns, whatever the corner of the grid, so ties go to the first.
    keyed = written(cells.select("r", "c", "v", "object", (F.col("r") * (1 << 31) + F.col("c")).alias("id"), F.col("c").cast("double").alias("x"), F.col("r").cast("double").alias("y")), "cells")
    kept, gaps = keyed.filter("NOT object"), keyed.filter("object")
    near = nearest(gaps.select("id", "x", "y"), kept.select("id", "x", "y"), axes=("x", "y"))
    filled = near.join(kept.select(F.col("id").alias("other"), "v"), "other").join(gaps.select("id", "r", "c"), "id").select("r", "c", "v")
    whole = written(kept.select("r", "c", "v").union(filled), "ground")

    def slope(axis: str):
        """The difference across a cell along an axis, over both neighbours or the one there is."""
        other = "c" if axis == "r" else "r"
        sides = whole.select(other, "v", F.explode(F.array(F.lit(-1), F.lit(1))).alias("side"), axis)
        sides = sides.select(other, (F.col(axis) + F.col("side")).alias(axis), (-F.col("side")).alias("side"), F.col("v").alias("near"))
        joined = whole.join(sides, ["r", "c"], "left").groupBy("r", "c", "v")
        run = F.count("side")
        low, high = F.coalesce(F.max(F.when(F.col("side") == -1, F.col("near"))), F.col("v")), F.coalesce(F.max(F.when(F.col("side") == 1, F.col("near"))), F.col("v"))
        return joined.agg((F.when(run > 0, (high - low) / run).otherwise(0.0) / gsd).alias(f"d{axis}"))

    both = slope("r").join(slope("c").drop("v"), ["r", "c"])
    return both.select("r", "c", "v", F.sqrt(F.col("dr") ** 2 + F.col("dc") ** 2).alias("steep"))


def classified(points: DataFrame, gsd: float = 1.0, slope: float = SLOPE, windows: tuple[int, ...] = WINDOWS, slack: float = SLACK, scalar: float = SCALAR) -> DataFrame:
    """points (id, x, y, z) with class: noise, ground or other.

    Outliers are noise, and the surface does without them. A point is ground if it lies no further
    from the ground surface of its cell than the slack and what the slope there adds to it."""
    flags = outliers(points).select("id", "outlier")
    rows = written(points.select("id", "x", "y", "z").join(flags, "id").withColumns({"r": F.floor(F.col("y") / gsd), "c": F.floor(F.col("x") / gsd)}), "points")
    surface = ground_surface(opened_cells(lowest_surface(rows.filter("NOT outlier"), gsd), gsd, slope, windows), gsd)
    found = rows.join(surface, ["r", "c"], "left")
    near = F.abs(F.col("z") - F.col("v")) <= slack + scalar * F.col("steep")
    return found.select("id", "x", "y", "z", F.when(F.col("outlier"), NOISE).when(near, GROUND).otherwise(OTHER).alias("class"))
