"""Gridding of clouds and algebra of sparse rasters (r, c, v): an absent cell has no data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geokernel.operators.graph import linked_roots
from geokernel.operators.quantiles import median_and_deviation, one_row, values_of
from geokernel.operators.tables import Rounds, written

#: Robust sigma of a normal distribution by its median absolute deviation; 95 % of it.
MAD_SIGMA, Z95 = 1.4826, 1.96


def cell(v: Column, gsd: float, origin: float = 0.0) -> Column:
    """Index of the half-open cell; floor, so negative coordinates fall where they belong."""
    return F.floor((v - origin) / gsd).cast("long")


def binned(cloud: DataFrame, gsd: float, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    return cloud.withColumns({"r": cell(F.col("y"), gsd, y0), "c": cell(F.col("x"), gsd, x0)})


def max_surface(cloud: DataFrame, gsd: float, classes: tuple[int, ...] = ()) -> DataFrame:
    """Highest point of each cell, of all points or of some classes."""
    if classes:
        cloud = cloud.filter(F.col("cls").isin(*classes))
    return binned(cloud, gsd).groupBy("r", "c").agg(F.max("z").alias("v"))


def majority_class(cloud: DataFrame, gsd: float, code: Column) -> DataFrame:
    """Commonest class of each cell, the lowest on a tie; class 0 is no data."""
    counted = binned(cloud, gsd).withColumn("code", code).filter("code > 0").groupBy("r", "c", "code").agg(F.count("*").alias("n"))
    return counted.groupBy("r", "c").agg(F.max_by("code", F.struct(F.col("n"), -F.col("code"))).alias("v"))


def shared_bounds(a: DataFrame, b: DataFrame, gsd: float) -> DataFrame:
    """The bounds of two clouds snapped outwards to the cell size, and the grid's dimensions."""
    both = a.select("x", "y").union(b.select("x", "y"))
    lo = lambda c: (F.floor(F.min(c) / gsd) * gsd).cast("double")
    hi = lambda c: (F.ceil(F.max(c) / gsd) * gsd).cast("double")
    box = both.agg(lo("x").alias("xmin"), lo("y").alias("ymin"), hi("x").alias("xmax"), hi("y").alias("ymax"))
    return box.withColumns({"width": F.greatest(F.lit(1), F.rint((F.col("xmax") - F.col("xmin")) / gsd)).cast("long"), "height": F.greatest(F.lit(1), F.rint((F.col("ymax") - F.col("ymin")) / gsd)).cast("long")})


def valid_cells(cells: DataFrame) -> DataFrame:
    """One row (valid): the number of cells whose value is a number."""
    return cells.agg(F.count_if(F.col("v").isNotNull() & ~F.isnan(F.col("v").cast("double"))).alias("valid"))


def difference(reference: DataFrame, later: DataFrame) -> DataFrame:
    """later - reference where both have data."""
    return reference.select("r", "c", F.col("v").alias("before")).join(later.select("r", "c", F.col("v").alias("after")), ["r", "c"]).withColumn("dz", F.col("after") - F.col("before"))


def level_of_detection(dz: DataFrame, registration_error: float = 0.0, z: float = Z95) -> DataFrame:
    """One row (lod): z times the larger of the robust sigma and the registration error."""
    _, mad = median_and_deviation(values_of(dz, F.col("dz")))
    return one_row(dz, lod=0.0 if mad is None else z * max(MAD_SIGMA * mad, abs(registration_error)))


def change_report(dz: DataFrame, lod: DataFrame, cell_area: float) -> DataFrame:
    """One row of volumes and areas: changes beyond the level of detection, and the raw net."""
    d = F.col("dz")
    real = ~F.isnan(d) & (F.abs(d) > F.col("lod"))
    up, down = F.when(real & (d > 0), d).otherwise(0.0), F.when(real & (d < 0), -d).otherwise(0.0)
    joined = dz.join(F.broadcast(lod))
    return joined.agg(
        F.count("*").alias("valid_cells"),
        F.coalesce(F.max("lod"), F.lit(0.0)).alias("lod"),
        F.avg("dz").alias("mean_dz"),
        F.max("dz").alias("max_dz"),
        F.min("dz").alias("min_dz"),
        F.coalesce(F.sum(F.when(real, cell_area).otherwise(0.0)), F.lit(0.0)).alias("changed_area"),
        F.coalesce(F.sum(up) * cell_area, F.lit(0.0)).alias("fill"),
        F.coalesce(F.sum(down) * cell_area, F.lit(0.0)).alias("cut"),
        F.coalesce((F.sum(up) - F.sum(down)) * cell_area, F.lit(0.0)).alias("net"),
        F.coalesce(F.sum(d) * cell_area, F.lit(0.0)).alias("net_raw"),
    )


def transitions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Carried-forward class and transition code a * 10 + b of cells seen in either epoch; a
    cell that the later epoch does not see keeps its class."""
    a, b = before.select("r", "c", F.col("v").alias("a")), after.select("r", "c", F.col("v").alias("b"))
    both = a.join(b, ["r", "c"], "full")
    carried = F.coalesce("b", "a")
    changed = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    return both.select("r", "c", carried.cast("int").alias("carried"), F.when(changed, F.col("a") * 10 + F.col("b")).otherwise(0).cast("int").alias("code"), F.col("b").isNull().alias("from_before"))


def transition_areas(codes: DataFrame, cell_area: float) -> DataFrame:
    return codes.filter("code > 0").groupBy("code").agg((F.count("*") * cell_area).alias("area"))


def whole_target(cells: DataFrame, source_gsd: float = 1.0, gsd: float = 1.0) -> DataFrame:
    """Target cells (r, c) that cover the bounds of cells, from one aggregate over them."""
    ends = cells.agg(*[f(a).alias(f"{n}_{a}") for a in ("r", "c") for n, f in (("lo", F.min), ("hi", F.max))])
    steps = lambda a: F.explode(F.sequence(F.floor(F.col(f"lo_{a}") * source_gsd / gsd).cast("long"), F.ceil((F.col(f"hi_{a}") + 1) * source_gsd / gsd).cast("long") - 1))
    return ends.filter("lo_r IS NOT NULL").withColumn("r", steps("r")).withColumn("c", steps("c")).select("r", "c")


def nearest_resample(cells: DataFrame, source_gsd: float, gsd: float, target: DataFrame) -> DataFrame:
    """The value of the source cell below the centre of each target cell (r, c)."""
    at = target.select("r", "c", F.floor((F.col("r") + 0.5) * gsd / source_gsd).cast("long").alias("sr"), F.floor((F.col("c") + 0.5) * gsd / source_gsd).cast("long").alias("sc"))
    return at.join(cells.select(F.col("r").alias("sr"), F.col("c").alias("sc"), "v"), ["sr", "sc"]).select("r", "c", "v")


def bilinear_resample(cells: DataFrame, source_gsd: float, gsd: float, target: DataFrame) -> DataFrame:
    """Bilinear mean of the four source cells around a target centre; needs all four."""
    y, x = (F.col("r") + 0.5) * gsd / source_gsd - 0.5, (F.col("c") + 0.5) * gsd / source_gsd - 0.5
    at = target.select("r", "c", y.alias("y"), x.alias("x")).withColumns({"r0": F.floor("y").cast("long"), "c0": F.floor("x").cast("long")})
    fy, fx = F.col("y") - F.col("r0"), F.col("x") - F.col("c0")
    corner = lambda dr, dc: F.struct((F.col("r0") + dr).alias("sr"), (F.col("c0") + dc).alias("sc"), ((fy if dr else 1 - fy) * (fx if dc else 1 - fx)).alias("w"))
    parts = at.select("r", "c", F.inline(F.array(*[corner(dr, dc) for dr in (0, 1) for dc in (0, 1)])))
    hit = parts.join(cells.select(F.col("r").alias("sr"), F.col("c").alias("sc"), "v"), ["sr", "sc"])
    return hit.groupBy("r", "c").agg(F.sum(F.col("w") * F.col("v")).alias("v"), F.count("*").alias("n")).filter("n = 4").drop("n")


def focal(cells: DataFrame, radius: int, reduce: str) -> DataFrame:
    """Minimum or maximum over a square window, rows first and then columns."""
    fn = {"min": F.min, "max": F.max}[reduce]
    seen = cells.select("r", "c")
    for axis in ("r", "c"):
        spread = cells.withColumn("d", F.explode(F.sequence(F.lit(-radius), F.lit(radius)))).withColumn(axis, F.col(axis) + F.col("d"))
        cells = spread.groupBy("r", "c").agg(fn("v").alias("v"))
    return cells.join(seen, ["r", "c"], "left_semi")


def opening(cells: DataFrame, radius: int) -> DataFrame:
    return focal(focal(cells, radius, "min"), radius, "max")


def ground_cells(lowest: DataFrame, gsd: float, slope: float = 0.15, windows: tuple[int, ...] = (1, 2, 4), threshold: float = 0.5) -> DataFrame:
    """Simple morphological ground filter on a lowest-point grid (Pingel et al., 2013): a cell
    is an object where an opening by any window lowers it by more than slope * window."""
    flagged = lowest.withColumn("object", F.lit(False))
    surface = lowest
    for radius in windows:
        opened = opening(surface, radius).withColumnRenamed("v", "opened")
        flagged = flagged.join(surface.withColumnRenamed("v", "before"), ["r", "c"]).join(opened, ["r", "c"]).withColumn("object", F.col("object") | (F.col("before") - F.col("opened") > slope * radius * gsd + threshold)).drop("before", "opened")
        surface = opened.withColumnRenamed("opened", "v")
    return flagged.filter(~F.col("object")).select("r", "c", "v")


def inverse_distance_fill(cells: DataFrame, target: DataFrame, radius: int = 3) -> DataFrame:
    """Values of target cells: their own, or the mean by inverse squared distance of the cells
    within a window; targets without any stay absent."""
    offsets = F.explode(F.array(*[F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)]))
    gaps = target.join(cells, ["r", "c"], "left_anti").withColumn("o", offsets)
    gaps = gaps.select("r", "c", (F.col("r") + F.col("o.dr")).alias("sr"), (F.col("c") + F.col("o.dc")).alias("sc"), F.nullif(F.col("o.dr") * F.col("o.dr") + F.col("o.dc") * F.col("o.dc"), F.lit(0)).alias("d2"))
    near = gaps.join(cells.select(F.col("r").alias("sr"), F.col("c").alias("sc"), "v"), ["sr", "sc"])
    filled = near.groupBy("r", "c").agg((F.sum(F.col("v") / F.col("d2")) / F.sum(1.0 / F.col("d2"))).alias("v"))
    return target.join(cells, ["r", "c"]).select("r", "c", "v").union(filled)


def lowpass(cells: DataFrame, sigma: float, truncate: float = 4.0) -> DataFrame:
    """Gaussian mean over the cells with data, weights normalised over them."""
    import math

    reach = int(truncate * sigma + 0.5)
    kernel = F.map_from_arrays(F.array(*[F.lit(d) for d in range(-reach, reach + 1)]), F.array(*[F.lit(math.exp(-0.5 * (d / sigma) ** 2)) for d in range(-reach, reach + 1)]))
    state = cells.select("r", "c", F.col("v").alias("s"), F.lit(1.0).alias("w"))
    for axis in ("r", "c"):
        spread = state.select("r", "c", "s", "w", F.explode(kernel).alias("d", "k")).withColumn(axis, F.col(axis) + F.col("d"))
        state = spread.groupBy("r", "c").agg(F.sum(F.col("s") * F.col("k")).alias("s"), F.sum(F.col("w") * F.col("k")).alias("w"))
    smooth = state.select("r", "c", (F.col("s") / F.greatest(F.col("w"), F.lit(1e-6))).alias("low"))
    return cells.join(smooth, ["r", "c"])


def contour_segments(cells: DataFrame, interval: float) -> DataFrame:
    """Marching squares on cell centres: (r, c, level, x0, y0, x1, y1, e0, e1, up0), r and c of the
    square's first corner. A corner at the level counts as above; saddles are cut by their mean.

    e0 and e1 are the cell edges that the ends lie on; up0 tells that, going around the square,
    the ground rises over the level at the first end, and so falls at the other."""
    corner = lambda name, dr, dc: cells.select((F.col("r") - dr).alias("r"), (F.col("c") - dc).alias("c"), F.col("v").alias(name))
    square = corner("a", 0, 0).join(corner("b", 0, 1), ["r", "c"]).join(corner("d", 1, 0), ["r", "c"]).join(corner("e", 1, 1), ["r", "c"])
    lo, hi = F.least("a", "b", "d", "e"), F.greatest("a", "b", "d", "e")
    square = square.filter(hi > lo).withColumn("k", F.explode(F.sequence(F.floor(lo / interval).cast("long"), F.floor(hi / interval).cast("long"))))
    square = square.withColumn("level", F.col("k") * F.lit(interval)).filter((F.col("level") > lo) & (F.col("level") <= hi))
    level = F.col("level")
    t = lambda p, q: (level - F.col(p)) / F.nullif(F.col(q) - F.col(p), F.lit(0.0))
    cut = lambda p, q: (F.col(p) >= level) != (F.col(q) >= level)
    edge = lambda dr, dc, down: F.struct((F.col("r") + dr).alias("r"), (F.col("c") + dc).alias("c"), F.lit(down).alias("down"))
    point = lambda p, q, x, y, e, after: F.when(cut(p, q), F.struct(x.alias("x"), y.alias("y"), e.alias("e"), (F.col(after) >= level).alias("up")))
    c, r = F.col("c").cast("double"), F.col("r").cast("double")
    top = point("a", "b", c + t("a", "b"), r, edge(0, 0, False), "b")
    right = point("b", "e", c + 1.0, r + t("b", "e"), edge(0, 1, True), "e")
    bottom = point("d", "e", c + t("d", "e"), r + 1.0, edge(1, 0, False), "d")
    left = point("a", "d", c, r + t("a", "d"), edge(0, 0, True), "a")
    square = square.withColumns({"top": top, "right": right, "bottom": bottom, "left": left})
    pts = F.filter(F.array("top", "right", "bottom", "left"), lambda p: p.isNotNull())
    centre_above = (F.col("a") + F.col("b") + F.col("d") + F.col("e")) / 4.0 >= level
    first = F.when(centre_above == (F.col("a") >= level), F.array(F.array("top", "right"), F.array("bottom", "left"))).otherwise(F.array(F.array("top", "left"), F.array("bottom", "right")))
    lines = F.when(F.size(pts) == 4, first).otherwise(F.array(pts))
    out = square.select("r", "c", "level", F.explode(lines).alias("p"))
    p, q = F.col("p")[0], F.col("p")[1]
    return out.select("r", "c", "level", p["x"].alias("x0"), p["y"].alias("y0"), q["x"].alias("x1"), q["y"].alias("y1"), p["e"].alias("e0"), q["e"].alias("e1"), p["up"].alias("up0"))


def contour_lines(segments: DataFrame) -> DataFrame:
    """(line, level, closed, position, x, y): the points of each line in order, from segments of
    contour_segments. line is the smallest number of its segments; a closed line ends where it
    starts.

    Segments run with higher ground on one side, so an edge is the end of one segment at most and
    the start of one other. Lines are the chains of these; places in them come from pointers
    that jump twice as far each round."""
    spark = segments.sparkSession
    ends = lambda name, i, j: F.when(F.col("up0"), F.col(f"{name}{i}")).otherwise(F.col(f"{name}{j}"))
    directed = segments.select("level", ends("e", 0, 1).alias("start"), ends("e", 1, 0).alias("end"), *[ends(a, 0, 1).alias(f"{a}0") for a in "xy"], *[ends(a, 1, 0).alias(f"{a}1") for a in "xy"])
    directed = written(directed.withColumn("id", F.monotonically_increasing_id()), "segments")
    nexts = directed.select(F.col("level"), F.col("start").alias("end"), F.col("id").alias("next"))
    chained = written(directed.select("id", "level", "end").join(nexts, ["level", "end"], "left").select("id", "next"), "chain")
    roots = linked_roots(chained.filter("next IS NOT NULL").select(F.col("id").alias("a"), F.col("next").alias("b"))).withColumnsRenamed({"node": "id", "root": "line"})
    named = chained.join(roots, "id", "left").withColumn("line", F.coalesce("line", "id"))
    shape = named.groupBy("line").agg(F.count("*").alias("segments"), (F.count("*") == F.count("next")).alias("closed"))
    named = written(named.join(shape, "line"), "lines")
    # A closed line is opened before its first segment; then all lines end.
    steps = Rounds(spark, "places")
    onward = F.when(~(F.col("closed") & (F.col("next") == F.col("line"))), F.col("next"))
    now = steps.write(named.select("id", onward.alias("next")).withColumn("left", F.col("next").isNotNull().cast("long")))
    while not now.filter("next IS NOT NULL").isEmpty():
        ahead = now.select(F.col("id").alias("next"), F.col("next").alias("further"), F.col("left").alias("more"))
        now = steps.write(now.join(ahead, "next", "left").select("id", F.col("further").alias("next"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left")))
    placed = named.select("id", "line", "closed", "segments").join(now.select("id", "left"), "id").join(directed.drop("start", "end"), "id")
    first = F.struct(F.lit(0).alias("last"), F.col("x0").alias("x"), F.col("y0").alias("y"))
    last = F.struct(F.lit(1).alias("last"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    points = placed.select("line", "level", "closed", (F.col("segments") - 1 - F.col("left")).alias("at"), F.inline(F.when(F.col("left") == 0, F.array(first, last)).otherwise(F.array(first))))
    return points.select("line", "level", "closed", (F.col("at") + F.col("last")).alias("position"), "x", "y")
