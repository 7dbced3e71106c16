"""Column functions: rotations, cameras, geodesy, colour. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]


def lit(x: float) -> Column:
    return F.lit(float(x))


# -- transforms ---------------------------------------------------------------------------


def rotate(r: Sequence[Column], v: Vec) -> Vec:
    """R v for nine row-major columns."""
    return tuple(r[3 * i] * v[0] + r[3 * i + 1] * v[1] + r[3 * i + 2] * v[2] for i in range(3))


def similarity(v: Vec, s: Column, r: Sequence[Column], t: Vec, offset: Vec | None = None) -> Vec:
    """s R v + t, less an offset where one is given."""
    out = tuple(s * x + d for x, d in zip(rotate(r, v), t, strict=True))
    return out if offset is None else tuple(x - o for x, o in zip(out, offset, strict=True))


def decentred_translation(r: Sequence[Column], t: Vec, o: Vec) -> Vec:
    """The translation of a rigid transform found in coordinates centred on o: t + o - R o."""
    return tuple(a + b - c for a, b, c in zip(t, o, rotate(r, o), strict=True))


def parse_matrix(text: Column) -> Column:
    """Sixteen numbers separated by white space as an array; null for any other count or text."""
    parts = F.transform(F.split(F.trim(text), r"\s+"), lambda x: x.try_cast("double"))
    return F.when((F.size(parts) == 16) & F.forall(parts, lambda x: x.isNotNull()), parts)


def quat_to_rot(w: Column, x: Column, y: Column, z: Column) -> Column:
    """Nine row-major elements of the rotation of a quaternion of any length."""
    n = w * w + x * x + y * y + z * z
    k = F.when(n > 0, 2.0 / F.nullif(n, lit(0)))
    one = lit(1)
    return F.array(
        one - k * (y * y + z * z), k * (x * y - w * z), k * (x * z + w * y),
        k * (x * y + w * z), one - k * (x * x + z * z), k * (y * z - w * x),
        k * (x * z - w * y), k * (y * z + w * x), one - k * (x * x + y * y),
    )


def rot_to_quat(r: Sequence[Column]) -> Column:
    """(w, x, y, z) with w or the largest component positive, by the largest of four pivots."""
    trace = r[0] + r[4] + r[8]

    def root(x: Column) -> Column:
        return F.sqrt(F.greatest(x, lit(0))) * 2.0

    a, b = root(trace + 1.0), root(lit(1) + r[0] - r[4] - r[8])
    c, d = root(lit(1) + r[4] - r[0] - r[8]), root(lit(1) + r[8] - r[0] - r[4])

    def q(s: Column, *parts: Column | None) -> Column:
        return F.array(*[s / 4.0 if p is None else p / F.nullif(s, lit(0)) for p in parts])

    return (
        F.when(trace > 0, q(a, None, r[7] - r[5], r[2] - r[6], r[3] - r[1]))
        .when((r[0] > r[4]) & (r[0] > r[8]), q(b, r[7] - r[5], None, r[1] + r[3], r[2] + r[6]))
        .when(r[4] > r[8], q(c, r[2] - r[6], r[1] + r[3], None, r[5] + r[7]))
        .otherwise(q(d, r[3] - r[1], r[2] + r[6], r[5] + r[7], None))
    )


def rot_to_axis_angle(r: Sequence[Column]) -> Vec:
    """The rotation vector; zero below an angle of 1e-8."""
    angle = F.acos(F.greatest(lit(-1), F.least(lit(1), (r[0] + r[4] + r[8] - 1.0) / 2.0)))
    k = F.when(angle < 1e-8, lit(0)).otherwise(angle / F.nullif(2.0 * F.sin(angle), lit(0)))
    return (k * (r[7] - r[5]), k * (r[2] - r[6]), k * (r[3] - r[1]))


def camera_centre(r: Sequence[Column], t: Vec) -> Vec:
    """-R' t: the centre of a camera whose pose takes world to camera."""
    return tuple(-(r[i] * t[0] + r[3 + i] * t[1] + r[6 + i] * t[2]) for i in range(3))


# -- cameras ------------------------------------------------------------------------------

#: Camera models with one focal length, and where their distortion begins.
ONE_FOCAL = ("SIMPLE_PINHOLE", "SIMPLE_RADIAL", "RADIAL")
MODELS = (*ONE_FOCAL, "PINHOLE", "OPENCV", "FULL_OPENCV", "OPENCV_FISHEYE")


def intrinsics(model: Column, params: Column) -> Column:
    """struct(fx, fy, cx, cy, dist) of a parameter array."""
    single = model.isin(*ONE_FOCAL)

    def at(i: int) -> Column:
        return F.get(params, F.when(single, i - 1 if i else 0).otherwise(i))

    start = F.when(single, 4).otherwise(5)
    dist = F.slice(params, start, F.greatest(F.size(params) - start + 1, F.lit(0)))
    return F.struct(at(0).alias("fx"), F.when(single, F.get(params, 0)).otherwise(F.get(params, 1)).alias("fy"), at(2).alias("cx"), at(3).alias("cy"), dist.alias("dist"))


def distort(model: Column, dist: Column, x: Column, y: Column) -> Column:
    """struct(x, y) of a normalised point after lens distortion; unknown models leave it."""

    def k(i: int) -> Column:
        return F.coalesce(F.get(dist, i), lit(0))

    r2 = x * x + y * y
    radial = F.when(model == "SIMPLE_RADIAL", 1.0 + k(0) * r2).otherwise(1.0 + r2 * (k(0) + r2 * k(1)))
    # OpenCV order: k1 k2 p1 p2 k3 k4 k5 k6
    top = 1.0 + r2 * (k(0) + r2 * (k(1) + r2 * k(4)))
    low = 1.0 + r2 * (k(5) + r2 * (k(6) + r2 * k(7)))
    cv = top / F.nullif(low, lit(0))
    tx = 2.0 * k(2) * x * y + k(3) * (r2 + 2.0 * x * x)
    ty = k(2) * (r2 + 2.0 * y * y) + 2.0 * k(3) * x * y
    r = F.sqrt(r2)
    a = F.atan(r)
    a2 = a * a
    fish = F.when(r < 1e-12, lit(1)).otherwise(a * (1.0 + a2 * (k(0) + a2 * (k(1) + a2 * (k(2) + a2 * k(3))))) / F.nullif(r, lit(0)))

    def pick(v: Column, tangential: Column) -> Column:
        return (
            F.when(model.isin("SIMPLE_RADIAL", "RADIAL"), v * radial)
            .when(model.isin("OPENCV", "FULL_OPENCV"), v * cv + tangential)
            .when(model == "OPENCV_FISHEYE", v * fish)
            .otherwise(v)
        )

    return F.struct(pick(x, tx).alias("x"), pick(y, ty).alias("y"))


def undistort(model: Column, dist: Column, x0: Column, y0: Column, rounds: int = 100, tolerance: float = 1e-12) -> Column:
    """struct(x, y): the fixed point of x <- x + x0 - D(x), at most so many rounds a row."""

    def step(state: Column, _: Column) -> Column:
        there = distort(model, dist, state["x"], state["y"])
        dx, dy = x0 - there["x"], y0 - there["y"]
        move = ~state["done"]
        return F.struct(
            F.when(move, state["x"] + dx).otherwise(state["x"]).alias("x"),
            F.when(move, state["y"] + dy).otherwise(state["y"]).alias("y"),
            (state["done"] | (F.greatest(F.abs(dx), F.abs(dy)) < tolerance)).alias("done"),
        )

    start = F.struct(x0.alias("x"), y0.alias("y"), F.lit(False).alias("done"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
    return F.struct(found["x"].alias("x"), found["y"].alias("y"))


def pinhole(p: Vec, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column]:
    """Pixel of a point in camera coordinates; null on or behind the image plane."""
    z = F.when(p[2] > 1e-6, p[2])
    return fx * p[0] / z + cx, fy * p[1] / z + cy


def view_weight(cosine: Column, distance2: Column, minimum: float = 0.15) -> Column:
    """cos^2 / d^2, or null below the least cosine."""
    return F.when(cosine > minimum, cosine * cosine / F.nullif(distance2, lit(0)))


# -- geodesy ------------------------------------------------------------------------------


def dms_to_degrees(d: Column, m: Column, s: Column, ref: Column) -> Column:
    value = d + m / 60.0 + s / 3600.0
    return F.when(F.upper(ref).isin("S", "W"), -value).otherwise(value)


def signed_altitude(altitude: Column, ref: Column) -> Column:
    """Below sea level where the reference byte is 1."""
    return F.when(F.coalesce(ref, F.lit(0)) == 1, -F.abs(altitude)).otherwise(altitude)


def utm_epsg(lon: Column, lat: Column) -> Column:
    zone = F.floor((lon + 180.0) / 6.0).cast("int") + 1
    return zone + F.when(lat >= 0, 32600).otherwise(32700)


#: The WGS84 ellipsoid and the scale and false origin of UTM.
WGS84_A, WGS84_F, UTM_SCALE, UTM_EAST, UTM_NORTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0


def utm_forward(lon: Column, lat: Column, zone: int, north: bool = True) -> tuple[Column, Column]:
    """(easting, northing) in a zone, by the Krueger series to the fourth order of n."""
    n = WGS84_F / (2 - WGS84_F)
    radius = WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    )
    e = 2 * n**0.5 / (1 + n)
    away = F.radians(lon - float(6 * zone - 183))
    sine = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sine) - e * F.atanh(e * sine))
    xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1.0 + t * t))
    north_part = xi + sum((a * F.sin(2.0 * j * xi) * F.cosh(2.0 * j * eta) for j, a in enumerate(alpha, 1)), lit(0))
    east_part = eta + sum((a * F.cos(2.0 * j * xi) * F.sinh(2.0 * j * eta) for j, a in enumerate(alpha, 1)), lit(0))
    return UTM_EAST + UTM_SCALE * radius * east_part, (0.0 if north else UTM_NORTH) + UTM_SCALE * radius * north_part


def utm_text(epsg: Column) -> Column:
    """`WGS84 UTM 37N` for a UTM code, else `EPSG:<code>`."""
    code = epsg.cast("string")
    named = F.concat(F.lit("WGS84 UTM "), F.substring(code, 4, 2).cast("int").cast("string"), F.when(code.startswith("326"), "N").otherwise("S"))
    return F.when(code.rlike("^32[67][0-9]{2}$"), named).otherwise(F.concat(F.lit("EPSG:"), code))


def tile_divisions(area: Column) -> Column:
    """ceil(log4(area / 10^4)) within 1 and 4."""
    # By comparison with the powers themselves: quotients of logarithms round up at 64.
    return F.when(area <= 4e4, 1).when(area <= 16e4, 2).when(area <= 64e4, 3).otherwise(4)


def resolve_gsd(width: Column, height: Column, cm: Column | None = None) -> Column:
    """Metres a cell: from centimetres, or diagonal / 4096 within 0.01 and 1, 0.05 unbounded."""
    diagonal = F.sqrt(width * width + height * height)
    auto = F.when(diagonal.isNull(), 0.05).otherwise(F.greatest(lit(0.01), F.least(lit(1), diagonal / 4096.0)))
    return auto if cm is None else F.coalesce(cm / 100.0, auto)


def budget_gsd(gsd: Column, area: Column, bytes_per_cell: float, budget: float) -> Column:
    """The cell size doubled until the raster fits a number of bytes."""
    doublings = F.ceil(F.ln(area * bytes_per_cell / (gsd * gsd * budget)) / F.ln(lit(4)))
    return gsd * F.pow(lit(2), F.greatest(lit(0), doublings.cast("double")))


# -- meshes -------------------------------------------------------------------------------


def cross(a: Vec, b: Vec) -> Vec:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def minus(a: Vec, b: Vec) -> Vec:
    return tuple(x - y for x, y in zip(a, b, strict=True))


def triangle_area(a: Vec, b: Vec, c: Vec) -> Column:
    n = cross(minus(b, a), minus(c, a))
    return F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2]) / 2.0


def centroid(a: Vec, b: Vec, c: Vec) -> Vec:
    return tuple((x + y + z) / 3.0 for x, y, z in zip(a, b, c, strict=True))


def barycentric(px: Column, py: Column, a: tuple, b: tuple, c: tuple) -> Vec:
    """Weights of a point in the plane; null for a triangle without area."""
    area = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    det = F.when(F.abs(area) > 1e-12, area)
    v = ((px - a[0]) * (c[1] - a[1]) - (py - a[1]) * (c[0] - a[0])) / det
    w = ((b[0] - a[0]) * (py - a[1]) - (b[1] - a[1]) * (px - a[0])) / det
    return (1.0 - v - w, v, w)


# -- classes and colour -------------------------------------------------------------------


def fold_class(code: Column) -> Column:
    """Point classes folded to 1 ground, 2 vegetation, 3 building, 0 other (fixed values)."""
    return F.when(code == 2, 1).when(code.isin(3, 4, 5), 2).when(code.isin(6, 64), 3).otherwise(0)


def majority_of_three(a: Column, b: Column, c: Column) -> Column:
    """The commonest non-zero class of three, the lowest on a tie, 0 if there is none."""
    some = F.array_sort(F.filter(F.array(a, b, c), lambda x: x > 0))
    pair = F.when((a == b) & (a > 0), a).when((b == c) & (b > 0), b).when((a == c) & (a > 0), a)
    return F.coalesce(pair, F.get(some, 0), F.lit(0))


def luma(r: Column, g: Column, b: Column) -> Column:
    return 0.299 * r + 0.587 * g + 0.114 * b


def tone(v: Column, brightness: float, gamma: float) -> Column:
    """Brightness (share of 255) and gamma, clipped and truncated to 0..255."""
    lifted = F.greatest(lit(0), F.least(lit(1), (v + brightness * 255.0) / 255.0))
    return F.floor(F.greatest(lit(0), F.least(lit(255), 255.0 * F.pow(lifted, lit(gamma))))).cast("int")


def quadratic_basis(x: Column, y: Column) -> list[Column]:
    return [x, y, x * x, x * y, y * y]


def photometric(value: Column, log_gain: Column, field: Column) -> Column:
    """value / exp(gain + field) with the field and the factor clipped."""
    bound = F.greatest(-F.ln(lit(1.6)), F.least(F.ln(lit(1.6)), field))
    return value / F.greatest(lit(0.4), F.least(lit(2.5), F.exp(log_gain + bound)))


def marker_parts(label: Column) -> tuple[Column, Column]:
    """(marker, corner) of `m<id>_c<k>`, null for other labels."""
    ok = label.rlike(r"^m[0-9]+_c[0-9]+$")
    return tuple(F.when(ok, F.regexp_extract(label, r"^m([0-9]+)_c([0-9]+)$", i).cast("int")) for i in (1, 2))
