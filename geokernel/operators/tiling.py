"""Spatial tiles with cores and halos."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geokernel.operators.tables import dealt

HALO_SPACINGS = 1.5
#: Dense points for each sparse one by density level.
DENSITY_FACTORS = (400, 100, 25, 8)


@dataclass(frozen=True)
class Grid:
    xmin: float
    ymin: float
    xmax: float
    ymax: float
    cols: int
    rows: int

    @staticmethod
    def over(points: DataFrame, tiles: int) -> Grid:
        """A near-square grid of at least so many cells over the points' bounds."""
        b = points.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
        xmin, ymin, xmax, ymax = (float(v or 0.0) for v in b)
        return Grid(xmin, ymin, xmax, ymax, *grid_dims(tiles, xmax - xmin, ymax - ymin))

    def cell(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(i, j) of a point, clamped into the grid."""

        def index(v: Column, low: float, high: float, n: int) -> Column:
            return F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor((v - low) / ((high - low) or 1.0) * n))).cast("long")

        return index(x, self.xmin, self.xmax, self.cols), index(y, self.ymin, self.ymax, self.rows)

    def cells(self, spark) -> DataFrame:
        """(i, j, x0, y0, x1, y1) of every cell; the last edges are the bounds themselves."""
        dx, dy = (self.xmax - self.xmin) / self.cols, (self.ymax - self.ymin) / self.rows
        ij = spark.range(self.cols * self.rows).select((F.col("id") % self.cols).alias("i"), F.floor(F.col("id") / self.cols).cast("long").alias("j"))
        edge = lambda k, n, low, high, d: F.when(k == n, high).otherwise(low + k * d)
        i, j = F.col("i"), F.col("j")
        return ij.select("i", "j", (self.xmin + i * dx).alias("x0"), (self.ymin + j * dy).alias("y0"), edge(i + 1, self.cols, self.xmin, self.xmax, dx).alias("x1"), edge(j + 1, self.rows, self.ymin, self.ymax, dy).alias("y1"))


def grid_dims(tiles: int, width: float, height: float) -> tuple[int, int]:
    """(columns, rows) by the aspect of the extent; halves are rounded to even."""
    if tiles <= 1:
        return 1, 1
    cols = max(1, round((tiles * (width / height if height > 1e-9 else 1.0)) ** 0.5))
    return cols, max(1, -(-tiles // cols))


def assigned(points: DataFrame, grid: Grid) -> DataFrame:
    i, j = grid.cell(F.col("x"), F.col("y"))
    return points.withColumns({"i": i, "j": j})


def halo(points: DataFrame, grid: Grid, radius: float) -> DataFrame:
    """(name, i, j) of points outside a cell but in its rectangle grown by the radius.

    A point looks only at the cells that its own rectangle of that radius touches, so the join
    is an equi-join on cells however many there are."""
    dx, dy = max((grid.xmax - grid.xmin) / grid.cols, 1e-12), max((grid.ymax - grid.ymin) / grid.rows, 1e-12)
    own = assigned(points, grid).withColumnsRenamed({"i": "own_i", "j": "own_j"})
    span = lambda v, low, d, n: F.sequence(F.greatest(F.lit(0), F.floor((v - radius - low) / d) - 1).cast("long"), F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((v + radius - low) / d) + 1)).cast("long"))
    near = own.withColumn("i", F.explode(span(F.col("x"), grid.xmin, dx, grid.cols))).withColumn("j", F.explode(span(F.col("y"), grid.ymin, dy, grid.rows)))
    cells = grid.cells(points.sparkSession)
    hit = near.join(cells, ["i", "j"]).filter(F.col("x").between(F.col("x0") - radius, F.col("x1") + radius) & F.col("y").between(F.col("y0") - radius, F.col("y1") + radius))
    return hit.filter((F.col("i") != F.col("own_i")) | (F.col("j") != F.col("own_j"))).select("name", "i", "j")


def members(points: DataFrame, grid: Grid, radius: float) -> DataFrame:
    """(i, j, name, part) of every tile: its own points (core) and those around it (halo)."""
    core = assigned(points, grid).select("i", "j", "name", F.lit("core").alias("part"))
    return core.union(halo(points, grid, radius).select("i", "j", "name", F.lit("halo")))


def partition(points: DataFrame, grid: Grid, radius: float) -> DataFrame:
    """Tiles with points of their own: id, i, j, how many points they and their halos have, and
    the first name of their own. Who they are is told by members()."""
    core = F.col("part") == "core"
    counts = members(points, grid, radius).groupBy("i", "j").agg(F.count_if(core).alias("n_core"), F.count_if(~core).alias("n_halo"), F.min(F.when(core, F.col("name"))).alias("first_name"))
    return counts.filter("n_core > 0").select(F.format_string("tile_%02d_%02d", "i", "j").alias("id"), "i", "j", "n_core", "n_halo", "first_name")


def tile_count(n_sparse: Column, budget: float, factor: float) -> Column:
    return F.greatest(F.lit(1), F.ceil(n_sparse * factor / budget)).cast("long")


def pending(tiles: DataFrame, status: DataFrame) -> DataFrame:
    """Tiles whose status is not done; tiles without a status are pending."""
    done = status.filter("status = 'done'").select("id")
    return tiles.join(done, "id", "left_anti")


def merged_clouds(clouds: DataFrame, bounds: DataFrame) -> DataFrame:
    """The points (tile, x, y, ...) of tile clouds that lie in their own tile's core, as one
    cloud. Tiles of the bounds (tile, x0, y0, x1, y1) without points are left out; with no
    points in any tile it is an error when the result is first counted or written."""
    kept = clouds.join(bounds, "tile").filter(F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1")))
    return kept.drop("x0", "y0", "x1", "y1")


def subset_model(images: DataFrame, cameras: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The images (tile, name, ...) of each tile's members (tile, name), and the cameras that
    the images of a tile use. Members that are no image are found by unequal()."""
    kept = members.select("tile", "name").distinct().join(dealt(images), "name")
    return kept, cameras.join(kept.select("tile", "camera_id").distinct(), "camera_id")


def unequal(got: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, with side: missing or extra. Empty if they are
    equal as sets."""
    # Both at once, in one grouping that combines equal rows before they are shuffled.
    both = got.withColumns({"in_got": F.lit(1), "in_wanted": F.lit(0)}).unionByName(wanted.select(*got.columns, F.lit(0).alias("in_got"), F.lit(1).alias("in_wanted")))
    found = both.groupBy(*got.columns).agg(F.max("in_got").alias("in_got"), F.max("in_wanted").alias("in_wanted")).filter("in_got <> in_wanted")
    return found.select(*got.columns, F.when(F.col("in_got") == 1, "extra").otherwise("missing").alias("side"))


#: Rows of a block when all pairs of a table are wanted.
BLOCK_ROWS = 1024


def block_pairs(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(left, right, places): a table twice, dealt so that a join on the places meets every pair of
    its rows once in either order, block by block. A task holds few blocks, however many rows."""
    n = max(1, -(-rows.count() // BLOCK_ROWS))
    block, others = F.pmod(F.xxhash64(key), F.lit(n)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    parts = min(4096, 1 + n * n // 4)
    left = rows.withColumn("i", block).withColumn("j", others).repartition(parts, "i", "j")
    right = rows.withColumn("j", block).withColumn("i", others).repartition(parts, "i", "j")
    return dealt(left), dealt(right), ["i", "j"]
