"""Change between two clouds along surveyed normals (Lague et al., 2013).

Normals come from second moments of neighbours, summed by core point at several radii in one pass;
their eigenvectors are closed forms of columns. A core point then looks at the points that its
cylinder can hold, both epochs at once, and what lies inside is summed on the spot."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geokernel.operators.tables import written
from geokernel.operators.tiles import CLEAR, PAIRS, Boxes, add_sums, between, squares, tile_sums, within

AXES = ("x", "y", "z")
#: Sine under which a direction counts as level.
LEVEL = 1e-9
_SUMS = ["n", *[f"m{i}" for i in range(3)], *[f"c{i}{j}" for i, j in PAIRS]]


def _dot(a: list[Column], b: list[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def _cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def _entry(i: int, j: int) -> Column:
    return F.col(f"c{min(i, j)}{max(i, j)}")


def eigenvalues(df: DataFrame) -> DataFrame:
    """df with the eigenvalues l0 <= l1 <= l2 of the symmetric matrix c00..c22."""
    e = _entry
    q = (e(0, 0) + e(1, 1) + e(2, 2)) / 3
    off = e(0, 1) * e(0, 1) + e(0, 2) * e(0, 2) + e(1, 2) * e(1, 2)
    diagonal = [e(i, i) - F.col("q") for i in range(3)]
    df = df.withColumn("q", q).withColumn("p", F.sqrt((_dot(diagonal, diagonal) + 2 * off) / 6))
    d = [e(i, i) - F.col("q") for i in range(3)]
    det = d[0] * (d[1] * d[2] - e(1, 2) * e(1, 2)) - e(0, 1) * (e(0, 1) * d[2] - e(1, 2) * e(0, 2)) + e(0, 2) * (e(0, 1) * e(1, 2) - d[1] * e(0, 2))
    p = F.col("p")
    third = F.when(p > 0, F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), det / (2 * p * p * p)))) / 3).otherwise(0.0)
    df = df.withColumn("phi", third)
    high = F.col("q") + 2 * p * F.cos("phi")
    low = F.col("q") + 2 * p * F.cos(F.col("phi") + 2 * math.pi / 3)
    return df.withColumns({"l0": low, "l1": 3 * F.col("q") - high - low, "l2": high}).drop("q", "p", "phi")


def _places(rows, extra: tuple[str, ...] = ()):
    """The rows whose coordinates (and extra columns) are finite, and those as arrays."""
    values = rows[[*AXES, *extra]].to_numpy(float)
    good = np.isfinite(values).all(axis=1)
    return rows[good], values[good]


def _moments(radii: tuple[float, ...]):
    """A kernel of tile_sums: for each radius the count, sums and sums of products of the offsets
    of the points within it."""

    def kernel(queries, points):
        queries, q = _places(queries)
        p = _places(points)[1]
        sums = np.zeros((len(radii), len(q), 10))
        if len(q) and len(p):
            origin = np.floor(q.min(axis=0))
            q, boxes = q - origin, Boxes(p - origin)
            for s, radius in enumerate(radii):
                _ball_sums(q, boxes, radius, sums[s])
        out = {"id": queries["id"]}
        for s in range(len(radii)):
            n, t = sums[s, :, 0], sums[s, :, 1:4]
            own = [t[:, i] - n * q[:, i] for i in range(3)]
            own += [sums[s, :, 4 + k] - q[:, i] * t[:, j] - q[:, j] * t[:, i] + n * q[:, i] * q[:, j] for k, (i, j) in enumerate(PAIRS)]
            out |= {f"{c}_{s}": v for c, v in zip(_SUMS, [n, *own], strict=True)}
        return pd.DataFrame(out)

    return kernel


def _ball_sums(q: np.ndarray, boxes: Boxes, radius: float, sums: np.ndarray) -> None:
    """Adds to sums what the products of the points within a radius of each query sum up to."""
    left, most = squares(q), radius * radius

    def decide(rows, low, high):
        nearest, farthest = between(q[rows], low, high)
        whole = farthest <= most * (1 - CLEAR)
        return whole, ~whole & (nearest <= most * (1 + CLEAR))

    def inside(rows, x):
        return within(left[rows] @ x.T, most, q[rows], x)

    add_sums(q, boxes, np.full((len(q), 2), radius), decide, inside, sums)


def normals(core: DataFrame, cloud: DataFrame, radii: tuple[float, ...]) -> DataFrame:
    """(id, nx, ny, nz, radius) of the core points (id, x, y, z) that have three neighbours in the
    cloud at one of the radii.

    Each radius has the covariance of the points within it; the radius of the most planar one,
    by (l1 - l0) / l2, gives the normal, its eigenvector of l0, turned upwards (a level one towards
    y, else x). Ties go to the smaller radius, points whose neighbours lie on a line or in one place
    have no normal."""
    schema = ", ".join([f"id {dict(core.dtypes)['id']}", *[f"{c}_{s} double" for s in range(len(radii)) for c in _SUMS]])
    wide = tile_sums(core, cloud, max(radii), _moments(radii), schema)
    each = F.array(*[F.struct(F.lit(float(r)).alias("radius"), *[F.col(f"{c}_{s}").alias(c) for c in _SUMS]) for s, r in enumerate(radii)])
    sums = wide.select("id", F.inline(each)).filter("n >= 3").select("id", "radius", *[(F.col(c) / F.col("n")).alias(c) for c in _SUMS[1:]])
    # Written, since filters that are pushed through closed forms would repeat them many times over.
    scales = written(eigenvalues(sums.select("id", "radius", *[(F.col(f"c{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")).alias(f"c{i}{j}") for i, j in PAIRS])), "scales")
    plane = F.when((F.col("l2") > 0) & (F.col("l1") > 1e-12 * F.col("l2")), (F.col("l1") - F.col("l0")) / F.col("l2"))
    best = F.max_by(F.struct("radius", "l0", *[f"c{i}{j}" for i, j in PAIRS]), F.struct(F.col("plane"), -F.col("radius")))
    chosen = scales.withColumn("plane", plane).filter("plane IS NOT NULL").groupBy("id").agg(best.alias("best")).select("id", "best.*")
    # The rows of C - l0 I span the plane; of their cross products the longest is the safest.
    row = [[_entry(i, j) - (F.col("l0") if i == j else F.lit(0.0)) for j in range(3)] for i in range(3)]
    found = [_cross(row[a], row[b]) for a, b in ((0, 1), (0, 2), (1, 2))]
    options = F.array(*[F.struct(_dot(v, v).alias("length"), (-F.lit(k)).alias("k"), *[v[i].alias(a) for i, a in enumerate(AXES)]) for k, v in enumerate(found)])
    v = chosen.select("id", "radius", F.array_max(options).alias("v")).filter("v.length > 0")
    level = F.abs(F.col("v.z")) <= LEVEL * F.sqrt("v.length")
    ahead = F.when(~level, F.col("v.z")).when(F.abs(F.col("v.y")) > LEVEL * F.sqrt("v.length"), F.col("v.y")).otherwise(F.col("v.x"))
    up = F.when(ahead < 0, -1.0).otherwise(1.0) / F.sqrt("v.length")
    return v.select("id", *[(F.col(f"v.{a}") * up).alias(f"n{a}") for a in AXES], "radius")


def _cylinders(radius: float, depth: float):
    """A kernel of tile_sums: of each epoch the points inside a cylinder around a core point's
    normal, the sums of their offsets along it, of the squares of those, and of their places."""

    def kernel(queries, points):
        queries, q = _places(queries, ("nx", "ny", "nz"))
        points, p = _places(points)
        late, place, n = points["late"].to_numpy(bool), q[:, :3], q[:, 3:]
        origin = np.floor(place.min(axis=0)) if len(q) else np.zeros(3)
        flat = bool((n[:, :2] == 0).all() and (n[:, 2] == 1).all())
        home, out = (place * n).sum(axis=1), {"id": queries["id"]}
        for epoch, held in enumerate((~late, late)):
            sums = np.zeros((len(q), 10))
            if len(q) and held.any():
                (_upright_sums if flat else _cylinder_sums)(place - origin, n, Boxes(p[held] - origin, flat), radius, depth, sums)
            m, own = sums[:, 0], ((place - origin) * n).sum(axis=1)
            t = (sums[:, 1:4] * n).sum(axis=1)
            tt = sum((2 - (i == j)) * n[:, i] * n[:, j] * sums[:, 4 + k] for k, (i, j) in enumerate(PAIRS))
            s = t - m * own
            out |= {f"n{epoch}": m, f"s{epoch}": s, f"ss{epoch}": tt - 2 * own * t + m * own * own, f"h{epoch}": s + m * home}
        return pd.DataFrame(out)[["id", *_ALONG]]

    return kernel


def _upright_sums(q: np.ndarray, _: np.ndarray, boxes: Boxes, radius: float, depth: float, sums: np.ndarray) -> None:
    """Adds to sums what the products of the points in each query's upright cylinder sum up to."""
    left, most = squares(q, 2), radius * radius

    def decide(rows, low, high):
        nearest, farthest = between(q[rows, :2], low[:, :2], high[:, :2])
        above, below = high[:, 2] - q[rows, 2].min(), q[rows, 2].max() - low[:, 2]
        whole = (farthest <= most * (1 - CLEAR)) & (above <= depth) & (below <= depth)
        return whole, ~whole & (nearest <= most * (1 + CLEAR))

    def inside(rows, x):
        found = within(left[rows] @ x.T, most, q[rows], x, 2)
        z = x[:, 3]
        if z.max() - q[rows, 2].min() > depth or q[rows, 2].max() - z.min() > depth:
            found &= np.abs(z - q[rows, 2, None]) <= depth
        return found

    add_sums(q, boxes, np.full((len(q), 2), radius), decide, inside, sums, True)


def _cylinder_sums(q: np.ndarray, n: np.ndarray, boxes: Boxes, radius: float, depth: float, sums: np.ndarray) -> None:
    """Adds to sums what the products of the points in the cylinder around each query's normal sum up to."""
    left, along_, own, slope = squares(q), np.zeros((len(q), 10)), (q * n).sum(axis=1), np.sqrt((n[:, :2] ** 2).sum(axis=1))
    along_[:, 0], along_[:, 1:4] = -own, n

    def decide(rows, low, high):
        half = (high - low) / 2
        middle = low + half
        # How far a box reaches along a normal, and away from it at most.
        long = np.abs(n[rows]) @ half.T
        across = np.sqrt((half[:, :2] ** 2).sum(axis=1))
        wide = np.minimum(across + half[:, 2] * slope[rows].max(), np.sqrt((half * half).sum(axis=1)))
        d = [middle[:, k] - q[rows, k, None] for k in range(3)]
        along = sum(d[k] * n[rows, k, None] for k in range(3))
        off = np.sqrt(np.maximum(sum(v * v for v in d) - along * along, 0.0))
        along = np.abs(along)
        slack = CLEAR ** 0.5 * (radius + depth)
        whole = (off.max(axis=0) <= radius - wide - slack) & ((along + long).max(axis=0) <= depth - slack)
        return whole, ~whole & (off.min(axis=0) <= radius + wide + slack) & ((along - long).min(axis=0) <= depth + slack)

    def inside(rows, x):
        p, at = x[:, 1:4], q[rows]
        along, d2 = along_[rows] @ x.T, left[rows] @ x.T
        off, most = d2 - along * along, radius * radius
        found = (np.abs(along) <= depth * (1 + CLEAR)) & (off <= most * (1 + CLEAR))
        sure = (np.abs(along) <= depth * (1 - CLEAR)) & (off <= most * (1 - CLEAR))
        if np.count_nonzero(sure) != np.count_nonzero(found):
            i, j = np.nonzero(sure ^ found)
            d = [p[j, k] - at[i, k] for k in range(3)]
            t = sum(d[k] * n[rows[i], k] for k in range(3))
            found[i, j] = (np.abs(t) <= depth) & (sum(v * v for v in d) - t * t <= most)
        return found

    add_sums(q, boxes, depth * np.abs(n[:, :2]) + radius, decide, inside, sums)


_ALONG = [f"{c}{late}" for c in ("n", "s", "ss", "h") for late in (0, 1)]


def _steepest(aimed: DataFrame) -> float:
    """The largest part of a normal along x or y."""
    return aimed.agg(F.max(F.greatest(F.abs("nx"), F.abs("ny")))).first()[0] or 0.0


def cylinder_change(core: DataFrame, before: DataFrame, after: DataFrame, radius: float, depth: float, registration_error: float = 0.0, z: float = 1.96) -> DataFrame:
    """(id, distance, lod, significant) along the normals of core (id, x, y, z, nx, ny, nz): the
    difference of both epochs' mean places along the axis of a cylinder, and its detection level.

    Every core point is kept. Without a normal, or without points of an epoch, its distance and
    level are null and it is not significant."""
    clouds = [c.select(*AXES, F.lit(late).alias("late")) for c, late in ((before, False), (after, True))]
    aimed = core.filter("nx IS NOT NULL").select("id", *AXES, "nx", "ny", "nz")
    schema = ", ".join([f"id {dict(core.dtypes)['id']}", *[f"{c} double" for c in _ALONG]])
    sums = tile_sums(aimed, clouds[0].union(clouds[1]), radius + depth * _steepest(aimed), _cylinders(radius, depth), schema, ("nx", "ny", "nz"), ("late",))
    n = [F.nullif(f"n{late}", F.lit(0.0)) for late in (0, 1)]
    s, ss, h = ([F.col(f"{c}{late}") for late in (0, 1)] for c in ("s", "ss", "h"))
    spread = [F.greatest(n[k] * ss[k] - s[k] * s[k], F.lit(0.0)) / (n[k] * n[k]) for k in (0, 1)]
    sums = sums.select("id", *[v.alias(f"{c}{k}") for k in (0, 1) for c, v in (("mean", h[k] / n[k]), ("var", spread[k]), ("n", n[k]))])
    out = core.select("id").join(sums, "id", "left")
    d = F.col("mean1") - F.col("mean0")
    lod = F.when(d.isNotNull(), z * (F.sqrt(F.col("var0") / F.col("n0") + F.col("var1") / F.col("n1")) + registration_error))
    return out.select("id", d.alias("distance"), lod.alias("lod"), F.coalesce(F.abs(d) > lod, F.lit(False)).alias("significant"))


def m3c2(core: DataFrame, before: DataFrame, after: DataFrame, radius: float, depth: float, registration_error: float = 0.0, z: float = 1.96) -> DataFrame:
    """cylinder_change along the vertical."""
    upright = core.select("id", *AXES, F.lit(0.0).alias("nx"), F.lit(0.0).alias("ny"), F.lit(1.0).alias("nz"))
    return cylinder_change(upright, before, after, radius, depth, registration_error, z)


def m3c2_surveyed(core: DataFrame, before: DataFrame, after: DataFrame, radius: float, depth: float | None = None, scales: tuple[float, ...] = (1.0, 2.0, 4.0), registration_error: float = 0.0) -> DataFrame:
    """cylinder_change along normals surveyed in the earlier epoch at multiples of the radius."""
    found = normals(core, before, tuple(s * radius for s in scales)).drop("radius")
    depth = max(30.0 * radius, 3.0) if depth is None else depth
    aimed = written(core.select("id", *AXES).join(found, "id", "left"), "normals")
    return cylinder_change(aimed, before, after, radius, depth, registration_error)
