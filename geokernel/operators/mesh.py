"""Triangle meshes: denormalised triangles, edges, patches, rasterisation, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geokernel.functions import scalar as S
from geokernel.operators.tables import dealt

CORNERS = (0, 1, 2)
#: Pixels along the side of a block of a triangle's bounding box.
BLOCK_PIXELS = 512
#: Faces that make a partition worthwhile.
PARTITION_FACES = 50_000


def triangles(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """faces with the coordinates of their corners: the gather is done once.

    How many tasks share it goes by the number of faces, so that one holds no more of a larger mesh."""
    parts, out = min(8192, 1 + faces.count() // PARTITION_FACES), faces
    for k in CORNERS:
        ends = vertices.select(F.col("vid").alias(f"v{k}"), *[F.col(a).alias(f"{a}{k}") for a in "xyz"])
        out = out.repartition(parts, f"v{k}").join(dealt(ends.repartition(parts, f"v{k}")), f"v{k}")
    return out


def corner(k: int) -> S.Vec:
    return tuple(F.col(f"{a}{k}") for a in "xyz")


def with_measures(tri: DataFrame) -> DataFrame:
    """tri with area and centroid cx, cy, cz."""
    c = S.centroid(*map(corner, CORNERS))
    return tri.withColumns({"area": S.triangle_area(*map(corner, CORNERS)), "cx": c[0], "cy": c[1], "cz": c[2]})


def mesh_stats(vertices: DataFrame, tri: DataFrame) -> DataFrame:
    v = vertices.agg(F.count("*").alias("n_vertices"), *[f(a).alias(f"{n}{a}") for a in "xyz" for n, f in (("min_", F.min), ("max_", F.max))])
    return v.join(F.broadcast(with_measures(tri).agg(F.count("*").alias("n_faces"), F.sum("area").alias("area"))))


def edges(faces: DataFrame) -> DataFrame:
    """(fid, lo, hi) for the three edges of each face."""
    pair = lambda a, b: F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    return faces.select("fid", F.inline(F.array(pair("v0", "v1"), pair("v1", "v2"), pair("v2", "v0"))))


def edge_multiplicity(faces: DataFrame) -> DataFrame:
    """One row: boundary (one face), manifold (two) and non-manifold edges."""
    n = edges(faces).groupBy("lo", "hi").agg(F.count("*").alias("n"))
    return n.agg(F.count_if(F.col("n") == 1).alias("boundary"), F.count_if(F.col("n") == 2).alias("manifold"), F.count_if(F.col("n") > 2).alias("non_manifold"))


def owned_faces(tri: DataFrame, x0: float, y0: float, x1: float, y1: float, inclusive: bool = False) -> DataFrame:
    """Triangles whose centroid lies in the rectangle, half-open unless inclusive."""
    c = S.centroid(*map(corner, CORNERS))
    inside = (c[0] >= x0) & (c[1] >= y0)
    return tri.filter(inside & (((c[0] <= x1) & (c[1] <= y1)) if inclusive else ((c[0] < x1) & (c[1] < y1))))


def fragments(tri: DataFrame, gsd: float, xmin: float, ymax: float) -> DataFrame:
    """(fid, r, c, w0, w1, w2, z): the pixels whose centres a triangle covers, seen from above.

    Each triangle is exploded over its own bounding box only; there is no join with pixels."""
    px = [(F.col(f"x{k}") - xmin) / gsd for k in CORNERS]
    py = [(ymax - F.col(f"y{k}")) / gsd for k in CORNERS]
    centre = lambda v, f: f(v - 0.5).cast("long")
    cols = (centre(F.least(*px), F.ceil), centre(F.greatest(*px), F.floor))
    rows = (centre(F.least(*py), F.ceil), centre(F.greatest(*py), F.floor))
    named = tri.select("fid", *[p.alias(f"px{k}") for k, p in enumerate(px)], *[p.alias(f"py{k}") for k, p in enumerate(py)], "z0", "z1", "z2", cols[0].alias("cl"), cols[1].alias("ch"), rows[0].alias("rl"), rows[1].alias("rh"))
    named = named.filter("cl <= ch AND rl <= rh")
    # A large triangle is cut into blocks that are dealt out before their pixels are listed.
    large = (F.col("ch") - F.col("cl") >= BLOCK_PIXELS) | (F.col("rh") - F.col("rl") >= BLOCK_PIXELS)
    blocks = named.filter(large)
    for lo, hi in (("rl", "rh"), ("cl", "ch")):
        blocks = blocks.withColumn("at", F.explode(F.sequence(F.col(lo), F.col(hi), F.lit(BLOCK_PIXELS).cast("long")))).withColumns({lo: F.col("at"), hi: F.least(F.col(hi), F.col("at") + (BLOCK_PIXELS - 1))}).drop("at")
    spread = named.filter(~large).unionByName(blocks.repartition("fid", "rl", "cl"))
    spread = spread.withColumn("r", F.explode(F.sequence("rl", "rh"))).withColumn("c", F.explode(F.sequence("cl", "ch")))
    w = S.barycentric(F.col("c") + 0.5, F.col("r") + 0.5, *[(F.col(f"px{k}"), F.col(f"py{k}")) for k in CORNERS])
    inside = spread.withColumns({f"w{k}": w[k] for k in CORNERS}).filter("w0 >= 0 AND w1 >= 0 AND w2 >= 0")
    return inside.select("fid", "r", "c", "w0", "w1", "w2", (F.col("w0") * F.col("z0") + F.col("w1") * F.col("z1") + F.col("w2") * F.col("z2")).alias("z"))


def rasterised(tri: DataFrame, gsd: float, xmin: float, ymax: float) -> DataFrame:
    """(r, c, z, fid, w0, w1, w2) of the highest triangle at each pixel, the lowest id on a tie."""
    f = fragments(tri, gsd, xmin, ymax)
    won = f.groupBy("r", "c").agg(F.max_by(F.struct("z", "fid", "w0", "w1", "w2"), F.struct(F.col("z"), -F.col("fid"))).alias("top"))
    return won.select("r", "c", "top.*")


def depth_map(fragments_by_view: DataFrame) -> DataFrame:
    """Nearest depth of each pixel of each view."""
    return fragments_by_view.groupBy("view", "r", "c").agg(F.min("z").alias("z"))


def bilinear(samples: DataFrame, image: DataFrame, width: int, height: int) -> DataFrame:
    """samples (id, u, v) with value: image (r, c, value) at pixel coordinates, clipped into it."""
    u = F.greatest(F.lit(0.0), F.least(F.lit(width - 1.001), F.col("u")))
    v = F.greatest(F.lit(0.0), F.least(F.lit(height - 1.001), F.col("v")))
    at = samples.select("id", u.alias("u"), v.alias("v")).withColumns({"c0": F.floor("u").cast("long"), "r0": F.floor("v").cast("long")})
    fu, fv = F.col("u") - F.col("c0"), F.col("v") - F.col("r0")
    part = lambda dr, dc: F.struct((F.col("r0") + dr).alias("r"), (F.col("c0") + dc).alias("c"), ((fv if dr else 1 - fv) * (fu if dc else 1 - fu)).alias("w"))
    return at.select("id", F.inline(F.array(*[part(i, j) for i in (0, 1) for j in (0, 1)]))).join(image, ["r", "c"]).groupBy("id").agg(F.sum(F.col("w") * F.col("value")).alias("value"))


def patches(faces: DataFrame, corners: DataFrame, steps: int = 1 << 14) -> DataFrame:
    """(fid, patch): faces joined over edges whose ends agree in vertex, texture place and page.

    corners: (fid, k, vid, u, v, page); texture places are compared on a grid."""
    from geokernel.operators.graph import components

    key = F.struct("vid", F.rint(F.col("u") * steps).cast("long").alias("qu"), F.rint(F.col("v") * steps).cast("long").alias("qv"), "page")
    keyed = corners.withColumn("key", key)
    nxt = keyed.select("fid", ((F.col("k") + 2) % 3).alias("k"), F.col("key").alias("next"))
    sides = keyed.select("fid", "k", "key").join(nxt, ["fid", "k"]).select("fid", F.least("key", "next").alias("lo"), F.greatest("key", "next").alias("hi"))
    w = Window.partitionBy("lo", "hi").orderBy("fid")
    links = sides.withColumn("b", F.lag("fid").over(w)).filter("b IS NOT NULL").select(F.col("fid").alias("a"), "b")
    return components(faces, links, "fid").select(F.col("id").alias("fid"), F.col("component").alias("patch"))


def merged(tiles: DataFrame, tile_faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices and faces of several tiles as one mesh: per-tile ids moved on by the sizes of
    the tiles before. tiles: (tile, vid, x, y, z) with vid dense from 0; tile_faces: (tile, fid, v0..v2)."""
    from geokernel.operators.topk import running_offsets

    sizes = running_offsets(tiles.groupBy("tile").agg(F.count("*").alias("n")), "tile", "n").select("tile", "offset")
    fsizes = running_offsets(tile_faces.groupBy("tile").agg(F.count("*").alias("n")), "tile", "n").select("tile", F.col("offset").alias("f_offset"))
    moved = tiles.join(sizes, "tile").select((F.col("vid") + F.col("offset")).alias("vid"), "x", "y", "z", "tile")
    faces = tile_faces.join(sizes, "tile").join(fsizes, "tile")
    return moved, faces.select((F.col("fid") + F.col("f_offset")).alias("fid"), *[(F.col(f"v{k}") + F.col("offset")).alias(f"v{k}") for k in CORNERS], "tile")


def view_weights(tri: DataFrame, views: DataFrame, margin: float = 4.0) -> DataFrame:
    """(fid, view, weight) of faces seen by pinhole views (view, r, t, f, cx, cy, width, height).

    A face counts for a view whose image holds its centroid inside the margin, at a cosine above
    the least one. Views meet only faces in the cells of their footprints; depth tests follow as
    an equi-join on depth cells."""
    from geokernel.operators.imagery import near_pairs

    a, b, c = map(corner, CORNERS)
    n = S.cross(S.minus(b, a), S.minus(c, a))
    size = F.nullif(F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2]), F.lit(0.0))
    m = with_measures(tri).select("fid", *[(n[i] / size).alias(f"n{i}") for i in range(3)], F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("cz").alias("z"))
    both = near_pairs(views, m).withColumnsRenamed({"cx": "px", "cy": "py", "x": "cx", "y": "cy", "z": "cz"})
    r, t = [F.col("r")[i] for i in range(9)], tuple(F.col("t")[i] for i in range(3))
    p = tuple(x + d for x, d in zip(S.rotate(r, (F.col("cx"), F.col("cy"), F.col("cz"))), t, strict=True))
    u, w = S.pinhole(p, F.col("f"), F.col("f"), F.col("px"), F.col("py"))
    centre = S.camera_centre(r, t)
    ray = tuple(x - y for x, y in zip(centre, (F.col("cx"), F.col("cy"), F.col("cz")), strict=True))
    d2 = ray[0] * ray[0] + ray[1] * ray[1] + ray[2] * ray[2]
    cosine = (ray[0] * F.col("n0") + ray[1] * F.col("n1") + ray[2] * F.col("n2")) / F.nullif(F.sqrt(d2), F.lit(0.0))
    inside = u.between(margin, F.col("width") - margin) & w.between(margin, F.col("height") - margin)
    return both.select("fid", "view", F.when(inside, S.view_weight(cosine, d2)).alias("weight")).filter("weight IS NOT NULL")
