"""Meshes of tiles as one mesh: faces cropped to their tile's core, vertices welded where tiles
meet, texture pages renamed by tile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geokernel.functions import scalar as S
from geokernel.operators import stats
from geokernel.operators.graph import linked_roots
from geokernel.operators.mesh import CORNERS
from geokernel.operators.neighbours import within_radius
from geokernel.operators.tables import dealt, written


def kept_faces(vertices: DataFrame, faces: DataFrame, bounds: DataFrame, pages: DataFrame, half_open: bool = False) -> DataFrame:
    """faces (tile, fid, v0, v1, v2, slot) with the page of their material slot, of those whose
    centroid lies in the core (x0, y0, x1, y1) of their tile, edges included (with half_open, high
    edges are not), and whose slot has a page."""
    ends = faces.select("tile", "fid", F.posexplode(F.array(*[f"v{k}" for k in CORNERS])).alias("k", "vid"))
    placed = ends.join(dealt(vertices.select("tile", "vid", "x", "y")), ["tile", "vid"]).groupBy("tile", "fid").agg(*[F.max(F.when(F.col("k") == k, F.col(a))).alias(f"{a}{k}") for k in CORNERS for a in "xy"])
    cx, cy, _ = S.centroid(*[(F.col(f"x{k}"), F.col(f"y{k}"), F.lit(0.0)) for k in CORNERS])
    core = bounds.select("tile", *[F.col(n).alias(f"b{n}") for n in ("x0", "y0", "x1", "y1")])
    below = (lambda a, b: a < b) if half_open else (lambda a, b: a <= b)
    inside = placed.join(core, "tile").filter((cx >= F.col("bx0")) & below(cx, F.col("bx1")) & (cy >= F.col("by0")) & below(cy, F.col("by1")))
    return faces.join(dealt(inside.select("tile", "fid")), ["tile", "fid"]).join(pages.filter("page IS NOT NULL"), ["tile", "slot"])


def merged_tiles(vertices: DataFrame, faces: DataFrame, bounds: DataFrame, pages: DataFrame, tolerance: float = 1e-3, half_open: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vertices, faces, materials) of the tiles' meshes as one.

    vertices: (tile, vid, x, y, z); faces: (tile, fid, v0, v1, v2, slot); bounds: (tile, x0, y0,
    x1, y1); pages: (tile, slot, page). Vertices that no face uses go. Vertices of different tiles
    that lie within the tolerance of each other, directly or through others, become the first of
    them by tile and number, so tiles meet without cracks; within a tile nothing is welded that no
    other tile links. New numbers are dense from 0, in the order of tiles; faces without three
    corners left go. Materials are named by tile and slot, pages by tile and their last part.
    Without any face it is an error."""
    kept = written(kept_faces(vertices, faces, bounds, pages, half_open), "kept-faces")
    if kept.isEmpty():
        raise ValueError("no face of any tile lies in its core")
    used = kept.select("tile", F.explode(F.array(*[f"v{k}" for k in CORNERS])).alias("vid")).distinct().join(dealt(vertices), ["tile", "vid"])
    used = written(stats.numbered(used.select(F.struct("tile", "vid").alias("at"), "tile", "vid", "x", "y", "z"), "at").withColumnRenamed("ordinal", "id"), "used")
    of = used.select(F.col("id").alias("other"), F.col("tile").alias("other_tile"))
    near = within_radius(used, used, tolerance).filter("id < other").join(dealt(used.select("id", "tile")), "id").join(dealt(of), "other").filter("tile <> other_tile")
    roots = linked_roots(near.select(F.col("id").alias("a"), F.col("other").alias("b"))).withColumnsRenamed({"node": "id"})
    welded = written(used.join(dealt(roots), "id", "left").withColumn("root", F.coalesce("root", "id")), "welded")
    out = stats.numbered(welded.filter("id = root").select("root", "x", "y", "z"), "root").withColumnRenamed("ordinal", "new")
    out = written(out, "merged-vertices")
    names = written(welded.join(dealt(out.select("root", "new")), "root").select("tile", "vid", "new"), "names")
    ends = kept.select("tile", "fid", "slot", F.posexplode(F.array(*[f"v{k}" for k in CORNERS])).alias("k", "vid")).join(dealt(names), ["tile", "vid"])
    flat = ends.groupBy("tile", "fid", "slot").agg(*[F.max(F.when(F.col("k") == k, F.col("new"))).alias(f"v{k}") for k in CORNERS])
    flat = flat.filter("v0 <> v1 AND v1 <> v2 AND v2 <> v0").withColumn("at", F.struct("tile", "fid"))
    material = F.concat(F.col("tile").cast("string"), F.lit("_mat"), F.col("slot").cast("string")).alias("material")
    named = stats.numbered(flat, "at").select(F.col("ordinal").alias("fid"), *[f"v{k}" for k in CORNERS], material, "tile")
    page = F.concat(F.col("tile").cast("string"), F.lit("_"), F.element_at(F.split("page", "/"), -1)).alias("page")
    materials = kept.select("tile", "slot", "page").distinct().select(material, page)
    return out.select(F.col("new").alias("vid"), "x", "y", "z"), named, materials


def boundary_edges(faces: DataFrame) -> DataFrame:
    """(lo, hi): the edges of one face alone; cracks between tiles would be among them."""
    from geokernel.operators.mesh import edges

    return edges(faces).groupBy("lo", "hi").count().filter("count = 1").select("lo", "hi")
