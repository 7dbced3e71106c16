"""Texture blending: which views a face is seen in, and texels mixed from those views' images.

Views and faces meet in cells of the views' footprints. Each view's depth map is one minimum by
depth cell, and a face is seen where its depth agrees with that of its cell. Texels are exploded
over their own faces, dealt out by view, and sampled where that view's image is: a task holds one
image at a time, and a view with very many texels is dealt to several tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geokernel.functions import scalar as S
from geokernel.operators import topk
from geokernel.operators.imagery import near_pairs
from geokernel.operators.mesh import CORNERS, with_measures
from geokernel.operators.tables import dealt, written

#: Views blended for a face, the least cosine of a view, share of the best weight that counts.
VIEWS, LEAST_COSINE, WEIGHT_FLOOR = 4, 0.15, 0.15
#: Pixels of a depth cell, cells along a side beyond which a face is not drawn, tolerances.
DEPTH_PIXELS, DEPTH_CELLS, DEPTH_SHARE, DEPTH_SLACK = 4, 32, 0.01, 0.05
#: Pixels along the frame that no view gives, and how far texels may lie outside their face.
MARGIN, OUTSIDE = 4.0, -0.02
#: Samples that one task takes from one image, on average.
SAMPLES_PER_PART = 500_000
BANDS = ("red", "green", "blue")
POSE = ("r", "t", "f", "cx", "cy", "width", "height")


def _seen_at(rows: pd.DataFrame, p: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, depth) of world points in the views of rows; u and v are not-a-number behind them."""
    at = [rows[f"r{3 * i}"] * p[0] + rows[f"r{3 * i + 1}"] * p[1] + rows[f"r{3 * i + 2}"] * p[2] + rows[f"t{i}"] for i in range(3)]
    x, y, depth = (v.to_numpy() for v in at)
    z = np.where(depth > 1e-6, depth, np.nan)
    f = rows["f"].to_numpy()
    return f * x / z + rows["px"].to_numpy(), f * y / z + rows["py"].to_numpy(), depth


def _each_pair(both: DataFrame, measure: Callable[[pd.DataFrame], pd.DataFrame], schema: str, *columns: str) -> DataFrame:
    """What measure yields of batches of faces beside views: as arrays, since the expressions of a
    pair are too long to be compiled by row."""
    number = lambda c: F.col(c).cast("double").alias(c)
    pose = [F.col("r")[i].cast("double").alias(f"r{i}") for i in range(9)] + [F.col("t")[i].cast("double").alias(f"t{i}") for i in range(3)]
    rows = both.select("fid", "view", *pose, *map(number, ("f", "px", "py", "width", "height", *columns)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with np.errstate(all="ignore"):
            for batch in batches:
                yield measure(batch)

    return rows.mapInPandas(run, schema)


def _beside(views: DataFrame, tri: DataFrame, reach: float) -> DataFrame:
    """Faces, with their centroid x, y, z, beside the views that may see a part of them."""
    m = with_measures(tri).select("fid", *[f"{a}{k}" for k in CORNERS for a in "xyz"], F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("cz").alias("z"))
    named = views.select("view", *POSE)
    return near_pairs(named, m, reach).withColumnsRenamed({"cx": "px", "cy": "py"})


def depth_cells(tri: DataFrame, views: DataFrame) -> DataFrame:
    """(view, r, c, depth): the nearest depth of the faces at the centre of each depth cell.

    Faces that reach behind the camera are not drawn, nor those that cover more than DEPTH_CELLS
    cells along a side: the tolerance of the comparison covers what they hide."""
    m = with_measures(tri)
    far = F.greatest(*[(F.col(f"x{k}") - F.col("cx")) ** 2 + (F.col(f"y{k}") - F.col("cy")) ** 2 for k in CORNERS])
    reach = float(m.agg(F.sqrt(F.max(far))).first()[0] or 0.0)
    corners = [f"{a}{k}" for k in CORNERS for a in "xyz"]

    def draw(rows: pd.DataFrame) -> pd.DataFrame:
        u, v, d = (np.stack(x) for x in zip(*[_seen_at(rows, [rows[f"{a}{k}"] for a in "xyz"]) for k in CORNERS], strict=True))
        u, v = u / DEPTH_PIXELS, v / DEPTH_PIXELS
        ahead = np.flatnonzero((d > 1e-6).all(axis=0) & np.isfinite(u).all(axis=0) & np.isfinite(v).all(axis=0))
        u, v, d, view = u[:, ahead], v[:, ahead], d[:, ahead], rows["view"].to_numpy()[ahead]
        w, h = (np.floor(rows[n].to_numpy()[ahead] / DEPTH_PIXELS) for n in ("width", "height"))
        c0, c1 = np.maximum(np.floor(u.min(axis=0)), 0), np.minimum(np.ceil(u.max(axis=0)) + 1, w)
        r0, r1 = np.maximum(np.floor(v.min(axis=0)), 0), np.minimum(np.ceil(v.max(axis=0)) + 1, h)
        at = np.flatnonzero((c1 > c0) & (r1 > r0) & (c1 - c0 <= DEPTH_CELLS) & (r1 - r0 <= DEPTH_CELLS))
        wide = (c1 - c0)[at].astype(np.int64)
        n = wide * (r1 - r0)[at].astype(np.int64)
        i, wide = np.repeat(at, n), np.repeat(wide, n)
        k = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        r, c = r0[i].astype(np.int64) + k // wide, c0[i].astype(np.int64) + k % wide
        (ua, ub, uc), (va, vb, vc), x, y = u[:, i], v[:, i], c + 0.5, r + 0.5
        area = (ub - ua) * (vc - va) - (vb - va) * (uc - ua)
        det = np.where(np.abs(area) > 1e-12, area, np.nan)
        w1 = ((x - ua) * (vc - va) - (y - va) * (uc - ua)) / det
        w2 = ((ub - ua) * (y - va) - (vb - va) * (x - ua)) / det
        w0 = 1.0 - w1 - w2
        held = (w0 >= 0) & (w1 >= 0) & (w2 >= 0)
        drawn = pd.DataFrame({"view": view[i], "r": r, "c": c, "depth": w0 * d[0, i] + w1 * d[1, i] + w2 * d[2, i]})[held]
        return drawn.groupby(["view", "r", "c"], as_index=False, sort=False)["depth"].min()

    drawn = _each_pair(_beside(views, tri, reach), draw, f"view {dict(views.dtypes)['view']}, r long, c long, depth double", *corners)
    return drawn.groupBy("view", "r", "c").agg(F.min("depth").alias("depth"))


def face_views(tri: DataFrame, views: DataFrame, margin: float = MARGIN, depth_test: bool = True) -> DataFrame:
    """(fid, view, weight) of the faces that pinhole views (view, r, t, f, cx, cy, width, height) see.

    A view counts whose frame, less the margin, holds the face's centroid, at a cosine above the
    least one, and in whose depth map nothing is nearer. The weight is cosine^2 / distance^2."""
    def weigh(rows: pd.DataFrame) -> pd.DataFrame:
        a, b, c = ([rows[f"{x}{k}"].to_numpy() for x in "xyz"] for k in CORNERS)
        n = np.cross(np.stack([q - p for p, q in zip(a, b, strict=True)], 1), np.stack([q - p for p, q in zip(a, c, strict=True)], 1)).T
        size = np.maximum(np.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2]), 1e-12)
        middle = [rows[x].to_numpy() for x in "xyz"]
        u, v, z = _seen_at(rows, middle)
        r, t = [rows[f"r{i}"].to_numpy() for i in range(9)], [rows[f"t{i}"].to_numpy() for i in range(3)]
        ray = [-(r[i] * t[0] + r[3 + i] * t[1] + r[6 + i] * t[2]) - middle[i] for i in range(3)]
        d2 = ray[0] * ray[0] + ray[1] * ray[1] + ray[2] * ray[2]
        cosine = (ray[0] * n[0] + ray[1] * n[1] + ray[2] * n[2]) / size / np.maximum(np.sqrt(d2), 1e-12)
        width, height = rows["width"].to_numpy(), rows["height"].to_numpy()
        weight = np.where(cosine > LEAST_COSINE, cosine * cosine / np.where(d2 == 0, np.nan, d2), np.nan)
        kept = (weight > 0) & (u >= margin) & (u < width - margin) & (v >= margin) & (v < height - margin)
        return pd.DataFrame({"fid": rows["fid"], "view": rows["view"], "width": width, "height": height, "u": u, "v": v, "z": z, "weight": weight})[kept]

    schema = f"fid {dict(tri.dtypes)['fid']}, view {dict(views.dtypes)['view']}, width double, height double, u double, v double, z double, weight double"
    found = _each_pair(_beside(views, tri, 0.0), weigh, schema, *[f"{x}{k}" for k in CORNERS for x in "xyz"], "x", "y", "z")
    if not depth_test:
        return found.select("fid", "view", "weight")
    at = lambda x, size: F.least(F.floor(F.col(x) / DEPTH_PIXELS), F.floor(F.col(size) / DEPTH_PIXELS) - 1)
    placed = found.withColumns({"r": at("v", "height"), "c": at("u", "width")})
    seen = placed.join(depth_cells(tri, views), ["view", "r", "c"], "left")
    return seen.filter(F.col("depth").isNull() | (F.col("z") <= F.col("depth") * (1 + DEPTH_SHARE) + DEPTH_SLACK)).select("fid", "view", "weight")


def blended_views(seen: DataFrame, k: int = VIEWS) -> DataFrame:
    """(fid, view, share): of each face the k heaviest views, those under a share of the best
    dropped, the others' weights made to sum to 1. Ties go to the lower view."""
    return topk.normalised(topk.top_k(seen, "fid", "weight", "view", k), "fid", "weight", WEIGHT_FLOOR).select("fid", "view", "share")


def texels(tri: DataFrame, uv: DataFrame, pages: DataFrame) -> DataFrame:
    """(fid, page, tr, tc, x, y, z): the texels of each face and their places in the world.

    uv: (fid, page, u0, v0 .. u2, v2), v upwards; pages: (page, width, height)."""
    corners = tri.select("fid", *[f"{a}{k}" for k in CORNERS for a in "xyz"])
    both = corners.join(dealt(uv.select("fid", "page", *[f"{n}{k}" for k in CORNERS for n in "uv"])), "fid").join(pages.select("page", F.col("width").alias("pw"), F.col("height").alias("ph")), "page")
    both = both.withColumns({f"px{k}": F.col(f"u{k}") * (F.col("pw") - 1) for k in CORNERS} | {f"py{k}": (1.0 - F.col(f"v{k}")) * (F.col("ph") - 1) for k in CORNERS})
    side = lambda n, f: f(*[F.col(f"{n}{k}") for k in CORNERS])
    zero = F.lit(0).cast("long")
    boxed = both.withColumns({"c0": F.greatest(F.floor(side("px", F.least)), zero), "c1": F.least(F.ceil(side("px", F.greatest)), F.col("pw") - 1), "r0": F.greatest(F.floor(side("py", F.least)), zero), "r1": F.least(F.ceil(side("py", F.greatest)), F.col("ph") - 1)}).filter("c1 >= c0 AND r1 >= r0")
    spread = boxed.withColumn("tr", F.explode(F.sequence("r0", "r1"))).withColumn("tc", F.explode(F.sequence("c0", "c1")))
    w = S.barycentric(F.col("tc") + 0.5, F.col("tr") + 0.5, *[(F.col(f"px{k}"), F.col(f"py{k}")) for k in CORNERS])
    inside = spread.withColumns({f"w{k}": w[k] for k in CORNERS}).filter(" AND ".join(f"w{k} >= {OUTSIDE}" for k in CORNERS))
    return inside.select("fid", "page", "tr", "tc", *[sum((F.col(f"w{k}") * F.col(f"{a}{k}") for k in CORNERS), F.lit(0.0)).alias(a) for a in "xyz"])


def decode_pnm(data: bytes) -> np.ndarray:
    """(height, width, 3) of a binary pixmap (P6, 8 bit), comments in its header included."""
    fields, at = [], 0
    while len(fields) < 4:
        end = at
        while data[end : end + 1].isspace():
            end += 1
        if data[end : end + 1] == b"#":
            at = data.index(b"\n", end) + 1
            continue
        at = end
        while not data[at : at + 1].isspace():
            at += 1
        fields.append(data[end:at])
    kind, width, height, depth = fields[0], *map(int, fields[1:])
    if kind != b"P6" or depth != 255:
        raise ValueError(f"not an 8-bit P6 pixmap: {kind!r} {depth}")
    return np.frombuffer(data, np.uint8, width * height * 3, at + 1).reshape(height, width, 3)


def image_files(spark: SparkSession, path: str, pattern: str = "*.ppm") -> DataFrame:
    """(view, content) of the image files below a folder; view is a file's path below it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    root = F.lit(path.rstrip("/").split("://")[-1].split(":", 1)[-1].lstrip("/") + "/")
    return files.select(F.element_at(F.split("path", root), -1).alias("view"), "content")


def _bilinear(image: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    h, w = image.shape[:2]
    u, v = np.clip(u, 0, w - 1.001), np.clip(v, 0, h - 1.001)
    c, r = np.maximum(u.astype(int), 0), np.maximum(v.astype(int), 0)
    right, below = np.minimum(c + 1, w - 1), np.minimum(r + 1, h - 1)
    fu, fv = (u - c)[:, None], (v - r)[:, None]
    top = image[r, c] * (1 - fu) + image[r, right] * fu
    return top * (1 - fv) + (image[below, c] * (1 - fu) + image[below, right] * fu) * fv


def sampled(places: DataFrame, images: DataFrame, decode: Callable[[bytes], np.ndarray] = decode_pnm) -> DataFrame:
    """places (view, u, v, ...) with red, green, blue: bilinear samples of images (view, content).

    Places of a view whose image is missing are left out. Images are decoded one at a time, in
    the tasks that sample them."""
    columns = [c for c in places.columns if c not in ("u", "v")]
    places = written(places, "places")
    parts = places.groupBy("view").agg(F.ceil(F.count("*") / SAMPLES_PER_PART).cast("int").alias("parts"))
    keyed = places.join(dealt(parts), "view").withColumn("part", F.pmod(F.xxhash64(*[F.col(c) for c in ("view", "u", "v")]), F.col("parts")).cast("int")).drop("parts")
    # Images are never broadcast: the size of their table says nothing of what decodes from it.
    held = images.join(dealt(parts), "view").select("view", "content", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    schema = ", ".join(f"`{c}` {places.schema[c].dataType.simpleString()}" for c in columns)

    def sample(rows: pa.Table, image: pa.Table) -> pa.Table:
        if not rows.num_rows or not image.num_rows:
            rows, colours = rows.slice(0, 0), np.zeros((0, 3))
        else:
            colours = _bilinear(decode(image["content"][0].as_py()), rows["u"].to_numpy(), rows["v"].to_numpy())
        out = rows.select(columns)
        for k, band in enumerate(BANDS):
            out = out.append_column(band, pa.array(colours[:, k].astype(float)))
        return out

    return keyed.groupBy("view", "part").cogroup(held.groupBy("view", "part")).applyInArrow(sample, f"{schema}, red double, green double, blue double")


#: Observations of an image that are sampled, and mean bands beyond which one counts as clipped.
MOST_OBSERVED, DARKEST, BRIGHTEST = 1500, 8, 247


def observed_colours(obs: DataFrame, images: DataFrame, most: int = MOST_OBSERVED, decode: Callable[[bytes], np.ndarray] = decode_pnm) -> DataFrame:
    """(view, pid, ordinal, x, y, red, green, blue) of observations (view, ordinal, pid, u, v): the
    means of the 3 x 3 pixels around them, and their place in the frame from -1 to 1.

    Of an image at most so many observations are looked at: those whose digest of the point and
    ordinal comes first, which is a permutation that does not change. Left out are then places
    at the edge of the frame and clipped colours. Images are decoded one at a time, in the task
    that samples them; views without an image are left out."""
    order = Window.partitionBy("view").orderBy(F.md5(F.concat_ws(":", "pid", "ordinal")), "ordinal")
    kept = obs.select("view", "ordinal", "pid", "u", "v").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")

    def sample(rows: pa.Table, image: pa.Table) -> pa.Table:
        columns = [rows["view"], rows["pid"], rows["ordinal"]]
        places, colours, inside = np.zeros((rows.num_rows, 2)), np.zeros((rows.num_rows, 3)), np.zeros(rows.num_rows, bool)
        if rows.num_rows and image.num_rows:
            pixels = decode(image["content"][0].as_py())
            h, w = pixels.shape[:2]
            u, v = rows["u"].to_numpy(), rows["v"].to_numpy()
            c, r = np.rint(u).astype(int), np.rint(v).astype(int)
            inside = (c >= 1) & (c < w - 1) & (r >= 1) & (r < h - 1)
            places = np.stack([2 * u / w - 1, 2 * v / h - 1], axis=1)
            at = np.flatnonzero(inside)
            colours[at] = np.mean([pixels[r[at] + i, c[at] + j].astype(float) for i in (-1, 0, 1) for j in (-1, 0, 1)], axis=0)
            inside &= (colours.min(axis=1) >= DARKEST) & (colours.max(axis=1) <= BRIGHTEST)
        columns += [pa.array(places[:, 0]), pa.array(places[:, 1]), *[pa.array(colours[:, k]) for k in range(3)]]
        return pa.Table.from_arrays(columns, ["view", "pid", "ordinal", "x", "y", *BANDS]).filter(pa.array(inside))

    kinds = dict(obs.dtypes)
    schema = f"view {kinds['view']}, pid {kinds['pid']}, ordinal {kinds['ordinal']}, x double, y double, red double, green double, blue double"
    return kept.groupBy("view").cogroup(images.select("view", "content").groupBy("view")).applyInArrow(sample, schema)


def baked(tri: DataFrame, uv: DataFrame, pages: DataFrame, views: DataFrame, images: DataFrame, decode: Callable[[bytes], np.ndarray] = decode_pnm) -> DataFrame:
    """(page, r, c, red, green, blue) of all texels that some view gives: samples of a face's
    views weighed by their shares, then the plain mean of the faces that have the texel.

    Bands are clipped to 0..255 and cut to whole numbers. Texels without a view are left out."""
    chosen = written(blended_views(face_views(tri, views)), "views")
    named = views.select("view", *POSE).withColumnsRenamed({"cx": "px", "cy": "py"})
    rows = texels(tri, uv, pages).join(dealt(chosen), "fid").join(dealt(named), "view")
    r, t = [F.col("r")[i] for i in range(9)], tuple(F.col("t")[i] for i in range(3))
    p = tuple(a + b for a, b in zip(S.rotate(r, tuple(F.col(x) for x in "xyz")), t, strict=True))
    z = F.greatest(p[2], F.lit(1e-6))
    places = rows.select("view", "fid", "page", "tr", "tc", "share", (F.col("f") * p[0] / z + F.col("px")).alias("u"), (F.col("f") * p[1] / z + F.col("py")).alias("v"))
    found = sampled(places, images, decode)
    face = found.groupBy("page", "tr", "tc", "fid").agg(*[(F.sum(F.col("share") * F.col(b)) / F.sum("share")).alias(b) for b in BANDS], F.sum("share").alias("shares")).filter("shares > 1e-6")
    whole = lambda b: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.avg(b)))).cast("int").alias(b)
    return face.groupBy("page", "tr", "tc").agg(*[whole(b) for b in BANDS]).select("page", F.col("tr").alias("r"), F.col("tc").alias("c"), *BANDS)


def page_texels(images: DataFrame, decode: Callable[[bytes], np.ndarray] = decode_pnm) -> DataFrame:
    """(page, r, c, red, green, blue) of the pixels of page images (page, content), row by row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, content in zip(batch["page"], batch["content"], strict=True):
                image = decode(content.as_py())
                h, w = image.shape[:2]
                for r in range(h):
                    yield pa.RecordBatch.from_arrays([pa.array([page.as_py()] * w, page.type), pa.array(np.full(w, r, np.int64)), pa.array(np.arange(w)), *[pa.array(image[r, :, k].astype(np.int32)) for k in range(3)]], ["page", "r", "c", *BANDS])

    kind = images.schema["page"].dataType.simpleString()
    return images.select("page", "content").mapInArrow(rows, f"page {kind}, r long, c long, red int, green int, blue int")


def over_pages(before: DataFrame, found: DataFrame) -> DataFrame:
    """Page texels (page, r, c, bands) with those replaced that were baked."""
    new = found.select("page", "r", "c", *[F.col(b).alias(f"new_{b}") for b in BANDS])
    return before.join(new, ["page", "r", "c"], "left").select("page", "r", "c", *[F.coalesce(f"new_{b}", b).alias(b) for b in BANDS])
