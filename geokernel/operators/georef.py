"""Georeferencing: from marked pixels or position fixes to pairs of local and world points."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geokernel.functions import scalar as S
from geokernel.operators.fit import triangulated
from geokernel.operators.tables import dealt, written


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def matched_names(markings: DataFrame, names: DataFrame) -> DataFrame:
    """markings (image, ...) with name: the image of exactly that name, else the one named like
    the last part of it. Markings of no known image are left out. names: one row a name."""
    known = names.select("name").distinct()
    exact = known.select(F.col("name").alias("exact_name"))
    last = known.select(F.col("name").alias("last_name"))
    found = markings.join(exact, F.col("image") == F.col("exact_name"), "left").join(last, base_name(F.col("image")) == F.col("last_name"), "left")
    return found.withColumn("name", F.coalesce("exact_name", "last_name")).filter("name IS NOT NULL").drop("exact_name", "last_name")


def viewing_rays(marked: DataFrame) -> DataFrame:
    """marked pixels (u, v) of posed images (q, t) and cameras (model, params), with their rays:
    the camera's centre cx, cy, cz and the unit direction dx, dy, dz in the local frame."""
    r = S.quat_to_rot(*[F.col("q")[i] for i in range(4)])
    posed = marked.withColumns({"ray_r": r, "ray_k": S.intrinsics(F.col("model"), F.col("params"))})
    x0, y0 = (F.col("u") - F.col("ray_k.cx")) / F.col("ray_k.fx"), (F.col("v") - F.col("ray_k.cy")) / F.col("ray_k.fy")
    posed = posed.withColumn("ray_p", S.undistort(F.col("model"), F.col("ray_k.dist"), x0, y0))
    r = [F.col("ray_r")[i] for i in range(9)]
    centre = S.camera_centre(r, tuple(F.col("t")[i] for i in range(3)))
    p = (F.col("ray_p.x"), F.col("ray_p.y"), S.lit(1))
    length = F.sqrt(p[0] * p[0] + p[1] * p[1] + 1.0)
    towards = [(r[i] * p[0] + r[3 + i] * p[1] + r[6 + i] * p[2]) / length for i in range(3)]
    rays = {f"c{a}": c for a, c in zip("xyz", centre, strict=True)} | {f"d{a}": d for a, d in zip("xyz", towards, strict=True)}
    return posed.withColumns(rays).drop("ray_r", "ray_k", "ray_p")


def nearest_observed(marked: DataFrame, observations: DataFrame, points: DataFrame, key: str = "line") -> DataFrame:
    """(key, pid, d2, x, y, z): of each marking the observed point whose pixel in the same image
    is nearest, the first observation on a tie. Observations of unknown points do not count.

    marked: (key, name, u, v); observations: (image, ordinal, u, v, pid); points: (pid, x, y, z)."""
    marked = marked.select(key, "name", F.col("u").cast("double").alias("u"), F.col("v").cast("double").alias("v")).filter("name IS NOT NULL")
    seen = observations.select(F.col("image").alias("name"), "ordinal", F.col("u").cast("double").alias("u"), F.col("v").cast("double").alias("v"), "pid")
    seen = seen.join(dealt(points.select("pid").distinct()), "pid", "left_semi")
    found = _nearest_pixels(marked, seen, key)
    best = found.groupBy(key).agg(F.min(F.struct(F.col("d2").isNull().alias("none"), "d2", "ordinal", "pid")).alias("best"))
    best = best.select(key, "best.pid", "best.d2").join(dealt(points.select("pid", "x", "y", "z")), "pid")
    place = best.groupBy(key, "pid", "d2").agg(F.min(F.struct("x", "y", "z")).alias("place"))
    return place.select(key, "pid", "d2", "place.x", "place.y", "place.z")


#: Observations that make a partition, and most that one piece of a bucket of images holds.
PARTITION_SEEN, MOST_SEEN, MOST_PAIRS = 250_000, 1_000_000, 4_000_000


def _nearest_pixels(marked: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """(key, d2, ordinal, pid): of each marking the nearest observation in each piece of its image.

    Images are dealt to buckets; what is marked in a bucket meets the observations of it inside a
    task, as arrays, so pairs are never rows. Buckets of very many observations, such as that of an
    image which has most of them, are cut into pieces that the markings go to."""
    seen = written(seen, "observations")
    buckets = int(min(8192, 1 + seen.count() // PARTITION_SEEN))
    bucket = F.pmod(F.xxhash64("name"), F.lit(buckets)).cast("int").alias("bucket")
    full = seen.select(bucket).groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > MOST_SEEN).select("bucket", F.ceil(F.col("n") / MOST_SEEN).cast("int").alias("pieces"))
    pieces = written(full, "pieces")  # at most a row a bucket
    parts = int(buckets + (pieces.agg(F.sum("pieces")).first()[0] or 0))
    with_pieces = lambda rows: rows.select("*", bucket).join(F.broadcast(pieces), "bucket", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    held = with_pieces(seen).withColumn("piece", F.pmod(F.xxhash64("ordinal", "pid"), F.col("pieces")).cast("int")).drop("pieces")
    asked = with_pieces(marked).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")

    def nearest(m: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        s = s.sort_values(["name", "ordinal", "pid"], kind="stable")
        rows, at, d2 = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]
        names, starts = np.unique(s["name"].to_numpy().astype(str), return_index=True)
        ends = np.append(starts[1:], len(s))
        places = np.searchsorted(names, wanted := m["name"].to_numpy().astype(str))
        known = np.flatnonzero(places < len(names))
        known = known[names[places[known]] == wanted[known]] if len(known) else known
        known = known[np.argsort(places[known], kind="stable")]
        u, v = (s[c].to_numpy(float) for c in "uv")
        x, y = (m[c].to_numpy(float) for c in "uv")
        for of in np.split(known, np.flatnonzero(np.diff(places[known])) + 1) if len(known) else ():
            a, z = starts[places[of[0]]], ends[places[of[0]]]
            step = max(1, MOST_PAIRS // (z - a))
            for some in (of[i : i + step] for i in range(0, len(of), step)):
                du, dv = u[a:z] - x[some, None], v[a:z] - y[some, None]
                d = du * du + dv * dv
                # The first of the nearest: observations are in order. No number comes last.
                i = np.where(np.isnan(d), np.inf, d).argmin(axis=1)
                rows.append(some)
                at.append(a + i)
                d2.append(d[np.arange(len(some)), i])
        rows, at, d2 = map(np.concatenate, (rows, at, d2))
        distance = pd.Series(d2, dtype=object).where(~np.isnan(d2), None) if np.isnan(d2).any() else d2
        return pd.DataFrame({key: m[key].take(rows).array, "d2": distance, "ordinal": s["ordinal"].take(at).array, "pid": s["pid"].take(at).array})

    kinds = dict(seen.dtypes)
    schema = f"`{key}` {dict(marked.dtypes)[key]}, d2 double, ordinal {kinds['ordinal']}, pid {kinds['pid']}"
    asked, held = (rows.repartition(parts, "bucket", "piece").groupBy("bucket", "piece") for rows in (asked, held))
    return asked.cogroup(held).applyInPandas(nearest, schema)


def control_points(markings: DataFrame, images: DataFrame, cameras: DataFrame, observations: DataFrame, points: DataFrame, least: int = 3) -> DataFrame:
    """(gid, label, wx, wy, wz, lx, ly, lz, method) of every control point that can be placed.

    Markings (line, wx, wy, wz, u, v, image, label) of one world position, to four decimals, are
    one point with the label of its first line. It is where the rays of its markings meet, or,
    with fewer than two rays or none that cross, the mean of the nearest observed points.
    Fewer than `least` points in all are an error."""
    rounded = [F.bround(c, 4).alias(c) for c in ("wx", "wy", "wz")]
    keyed = markings.select("line", *rounded, "u", "v", "image", "label")
    keyed = written(keyed.withColumn("gid", F.concat_ws(" ", "wx", "wy", "wz")), "markings")
    groups = keyed.groupBy("gid", "wx", "wy", "wz").agg(F.min_by("label", "line").alias("label"))
    marked = written(matched_names(keyed, images).select("line", "gid", "u", "v", "name"), "marked")
    posed = marked.join(images.select("name", "q", "t", "camera_id"), "name").join(cameras.select("camera_id", "model", "params"), "camera_id")
    crossing = written(triangulated(viewing_rays(posed).select("gid", *[f"{a}{b}" for a in "cd" for b in "xyz"]), "gid"), "crossing")
    rest = marked.join(crossing.select("gid"), "gid", "left_anti")
    near = nearest_observed(rest, observations, points).join(rest.select("line", "gid"), "line")
    near = near.groupBy("gid").agg(*[F.avg(a).alias(a) for a in "xyz"])
    placed = crossing.select("gid", "x", "y", "z", F.lit("triangulated").alias("method")).union(near.select("gid", "x", "y", "z", F.lit("nearest_point")))
    placed = written(groups.join(placed, "gid").select("gid", "label", "wx", "wy", "wz", F.col("x").alias("lx"), F.col("y").alias("ly"), F.col("z").alias("lz"), "method"), "control")
    if (n := placed.count()) < least:
        raise ValueError(f"only {n} control points can be placed, {least} are needed")
    return placed


def position_fixes(centres: DataFrame, fixes: DataFrame, least: int = 3) -> tuple[DataFrame, int]:
    """Pairs (name, lx, ly, lz, wx, wy, wz) of camera centres (name, x, y, z) and position fixes
    (name, lat, lon, alt), and the code of the UTM zone of the first fix, by name, that they are
    in. Fixes without a latitude or longitude do not count; fewer than `least` are an error."""
    good = fixes.filter("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)")
    both = written(centres.select("name", F.col("x").alias("lx"), F.col("y").alias("ly"), F.col("z").alias("lz")).join(good, "name"), "fixes")
    n, first = both.agg(F.count("*"), F.min(F.struct("name", "lon", "lat"))).first()
    if n < least:
        raise ValueError(f"only {n} position fixes, {least} are needed")
    zone, north = int((first["lon"] + 180) / 6) + 1, first["lat"] >= 0
    east, up = S.utm_forward(F.col("lon"), F.col("lat"), zone, north)
    return both.select("name", "lx", "ly", "lz", east.alias("wx"), up.alias("wy"), F.coalesce("alt", F.lit(0.0)).alias("wz")), zone + (32600 if north else 32700)


def mode(asked: Column, n_control: Column, n_fixes: Column, least: int = 3) -> Column:
    """How a model is placed: as asked if that can be done, else null; by default by control
    points, then by position fixes, then not at all (local)."""
    control, fixes = n_control >= least, n_fixes >= least
    chain = F.when(control, "gcp").when(fixes, "exif").otherwise("local")
    return (
        F.when(asked == "gcp", F.when(control, "gcp"))
        .when(asked == "exif", F.when(fixes, "exif"))
        .when(asked == "local", "local")
        .otherwise(chain)
    )


def frame_refusal(median_distance: Column, span: Column) -> Column:
    """Whether two data sets cannot be in one frame: their median distance exceeds the scene."""
    return F.coalesce(median_distance > span, F.lit(False))
