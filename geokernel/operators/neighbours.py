"""Nearest-neighbour and radius joins over a grid of cells.

A nearest join deals queries to tiles, and the points within reach of a tile go along. Inside a
task, queries that lie close together look at the points around them; what is found within reach is
settled. The others ask again with a wider reach, until it spans both sets. The first width comes
from how full cells are where the points are. The result is that of comparing all with all."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geokernel.operators.quantiles import median, one_row, quantiles, values_of
from geokernel.operators.tables import dealt, written

AXES = ("x", "y", "z")
#: Points that the cell of an average point may hold, besides the k asked for.
OCCUPANCY = 4.0
#: Queries that the tile of an average query holds, and bounds of one piece of a tile.
TILE_QUERIES, TILE_MOST, MOST_POINTS = 16_384.0, 65_536, 1_000_000
#: Widths around a tile from which points go along; queries of a block, and pairs of it at a time.
REACH, BLOCK, MOST_PAIRS = 4, 32, 4_000_000
#: Cells along an axis of a tile, rows that make a partition worthwhile, and queries that are few
#: enough to drop the points that no tile of theirs can see before they are shuffled.
MOST_CELLS, PARTITION_ROWS, FEW_QUERIES = 1 << 18, 16_384, 1_000_000
#: Bound on the sample that the first width is read from, and the widths that are tried.
WIDTH_ROWS, WIDTH_LEVELS = 50_000, 24


def _cells(axes: tuple[str, ...], width: float, shift: tuple[int, ...] | None = None) -> list[Column]:
    return [(F.floor(F.col(a) / width).cast("long") + (shift[i] if shift else 0)).alias(f"cell_{a}") for i, a in enumerate(axes)]


def _probes(queries: DataFrame, axes: tuple[str, ...], width: float) -> DataFrame:
    around = F.array(*[F.struct(*_cells(axes, width, s)) for s in product((-1, 0, 1), repeat=len(axes))])
    return queries.select("*", F.inline(around))


def _distance2(axes: tuple[str, ...]) -> Column:
    return sum(((F.col(a) - F.col(f"other_{a}")) * (F.col(a) - F.col(f"other_{a}")) for a in axes), F.lit(0.0))


def _pairs(queries: DataFrame, points: DataFrame, axes: tuple[str, ...], cell_axes: tuple[str, ...], width: float) -> DataFrame:
    keys = [f"cell_{a}" for a in cell_axes]
    held = points.select("*", *_cells(cell_axes, width)).select(*keys, F.col("id").alias("other"), *[F.col(a).alias(f"other_{a}") for a in axes], *[c for c in points.columns if c not in ("id", *axes)])
    return _probes(queries.select("id", *axes), cell_axes, width).join(dealt(held), keys).withColumn("d2", _distance2(axes))


def distinct_places(points: DataFrame, axes: tuple[str, ...], most: int) -> DataFrame:
    """Of points in exactly one place those with the lowest ids, as many as an answer can name."""
    order = Window.partitionBy(*axes).orderBy("id")
    return points.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")


def cell_width(points: DataFrame, axes: tuple[str, ...], span: float, n: int, occupancy: float) -> float:
    """The largest width, of those that halve the span, at which the cell of an average point
    holds at most so many points.

    Read off a bounded sample of WIDTH_ROWS points; the width decides how much is looked at, not
    what is found."""
    if span <= 0 or n == 0:
        return 1.0
    share = min(1.0, WIDTH_ROWS / n)
    sample = points.select(*axes).sample(share, 7) if share < 1 else points.select(*axes)
    levels = sample.withColumn("width", F.explode(F.array(*[F.lit(span / 2**j) for j in range(1, WIDTH_LEVELS)])))
    cells = levels.groupBy("width", *[F.floor(F.col(a) / F.col("width")).alias(f"cell_{a}") for a in axes]).agg(F.count("*").cast("double").alias("n"))
    full = cells.groupBy("width").agg((1 + (F.sum(F.col("n") * F.col("n")) / F.sum("n") - 1) / share).alias("full")).collect()
    fit = [r["width"] for r in full if r["full"] <= occupancy]
    return max(fit) if fit else span / 2 ** (WIDTH_LEVELS - 1)


def first_width(points: DataFrame, k: int = 1, axes: tuple[str, ...] = AXES) -> float:
    """The width that a nearest join over these points starts with, for joins that repeat."""
    box = points.agg(F.count("*").alias("n"), *[(F.max(a) - F.min(a)).alias(a) for a in axes]).first()
    return cell_width(points, axes, float(max((box[a] or 0.0) for a in axes)), box["n"], OCCUPANCY + k)


def _ranked(d2: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, rank) of the k smallest of each row, ties by the lower id; infinite ones are none."""
    if k < d2.shape[1]:
        rows, columns = np.nonzero(d2 <= np.partition(d2, k - 1, axis=1)[:, k - 1 : k])
    else:
        rows, columns = np.nonzero(d2 < np.inf)
    order = np.lexsort((ids[columns], d2[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    first = np.searchsorted(rows, np.arange(len(d2)))
    rank = np.arange(len(rows)) - first[rows] + 1
    kept = (rank <= k) & np.isfinite(d2[rows, columns])
    return rows[kept], columns[kept], rank[kept]


def _found(q: np.ndarray, own: np.ndarray | None, p: np.ndarray, ids: np.ndarray, cell_axes: int, width: float, reach: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, d2, rank): for each query the k nearest of the points, as far as reach tells.

    q, p: a row each; own: the ids of queries that are not their own neighbours. Queries that lie
    close together look at the points around them, first within a width, then within twice as much."""
    out = []
    both = [f(x[:, :cell_axes], axis=0) for f, x in ((np.min, q), (np.min, p), (np.max, q), (np.max, p))]
    # Nothing lies further away than all that is here reaches.
    reach = min(reach, float((np.maximum(*both[2:]) - np.minimum(*both[:2])).max()))
    left, width = np.arange(len(q)), min(width, reach)
    corner = p[:, :cell_axes].min(axis=0)
    while len(left):
        cell = max(width, float(np.ptp(p[:, :cell_axes], axis=0).max()) / MOST_CELLS) or 1.0
        at = np.floor((p[:, :cell_axes] - corner) / cell).astype(np.int64)
        most = at.max(axis=0)
        lines = at[:, 0]
        for a in range(1, cell_axes):
            lines = lines * (most[a] + 1) + at[:, a]
        order = np.argsort(lines, kind="stable")
        lines, unsettled = lines[order], []
        home = np.floor((q[left, :cell_axes] - corner) / cell).astype(np.int64)
        left = left[np.lexsort((*home.T, *(home // 2).T))]
        for start in range(0, len(left), BLOCK):
            rows = left[start : start + BLOCK]
            low, high = q[rows, :cell_axes].min(axis=0) - width, q[rows, :cell_axes].max(axis=0) + width
            lo, hi = np.maximum(np.floor((low - corner) / cell), 0).astype(np.int64), np.minimum(np.floor((high - corner) / cell), most).astype(np.int64)
            if (lo > hi).any():
                unsettled.append(rows)
                continue
            line = np.arange(lo[0], hi[0] + 1)
            for a in range(1, cell_axes - 1):
                line = (line[:, None] * (most[a] + 1) + np.arange(lo[a], hi[a] + 1)).ravel()
            ends = [np.searchsorted(lines, line * (most[-1] + 1) + v, side) for v, side in ((lo[-1], "left"), (hi[-1], "right"))]
            near = np.concatenate([order[x:y] for x, y in zip(*ends, strict=True)])
            if not len(near):
                unsettled.append(rows)
                continue
            step = max(1, MOST_PAIRS // len(near))
            for part in (rows[i : i + step] for i in range(0, len(rows), step)):
                d2 = np.zeros((len(part), len(near)))
                for a in range(q.shape[1]):
                    d = q[part, a][:, None] - p[near, a]
                    d2 += d * d
                if own is not None:
                    d2[own[part][:, None] == ids[near]] = np.inf
                i, j, rank = _ranked(d2, ids[near], k)
                if width < reach:
                    sure = np.zeros(len(part), bool)
                    sure[i[(rank == k) & (d2[i, j] <= width * width)]] = True
                    unsettled.append(part[~sure])
                    i, j, rank = i[sure[i]], j[sure[i]], rank[sure[i]]
                out.append((part[i], near[j], d2[i, j], rank))
        if width >= reach:
            break
        left, width = np.concatenate(unsettled) if unsettled else left[:0], min(2 * width, reach)
    return tuple(np.concatenate(x) if out else np.zeros(0, t) for x, t in zip(zip(*out) if out else ((),) * 4, (np.int64, np.int64, float, np.int64), strict=True))


def _candidates(queries: DataFrame, points: DataFrame, axes: tuple[str, ...], cell_axes: tuple[str, ...], width: float, k: int, exclude_self: bool, payload: tuple[str, ...], all_: bool, carried: tuple[str, ...] = ()) -> DataFrame:
    """(id, other, d2, rank, payload, carried, parts, sure): the up to k nearest points of each query in each
    piece of its tile, of how many pieces, and whether no point outside the tile can be nearer.

    A tile of queries meets the points within REACH widths of it inside a task (all_: all points)."""
    # Columns of their own on either side: a cloud may ask about itself.
    queries = queries.select("id", *[F.col(a).alias(a) for a in (*axes, *carried)])
    points = points.select(F.col("id").alias("other"), *[F.col(a).alias(a) for a in axes], *payload)
    plane = cell_axes[:2]
    reach = np.inf if all_ else REACH * width
    box = queries.agg(F.count("*").alias("n"), *[F.min(a).alias(f"l{a}") for a in plane], *[F.max(a).alias(f"h{a}") for a in plane]).first()
    n = box["n"]
    span = float(max((box[f"h{a}"] or 0.0) - (box[f"l{a}"] or 0.0) for a in plane))
    side = max(cell_width(queries, plane, span, n, TILE_QUERIES), 4 * width)
    keys = [f"tile{i}" for i in range(len(plane))]
    tile = lambda v: F.floor(v / side).cast("long")
    asked = queries.withColumns({t: tile(F.col(a)) for t, a in zip(keys, plane, strict=True)})
    n_queries = asked.groupBy(*keys).agg(F.count("*").alias("nq"))
    if all_:
        held = points.withColumns({t: F.lit(0).cast("long") for t in keys})
        asked = asked.withColumns({t: F.lit(0).cast("long") for t in keys})
        n_queries = asked.groupBy(*keys).agg(F.count("*").alias("nq"))
    else:
        near = [F.sequence(tile(F.col(a) - reach), tile(F.col(a) + reach)) for a in plane]
        held = points
        for t, s in zip(keys, near, strict=True):
            held = held.withColumn(t, F.explode(s))
        held = held.join(dealt(n_queries.select(*keys)), keys, "left_semi") if n < FEW_QUERIES else held
    n_points = held.groupBy(*keys).agg(F.count("*").alias("np"))
    pieces = written(n_queries.join(dealt(n_points), keys).select(*keys, F.ceil(F.col("nq") / TILE_MOST).alias("qi"), F.ceil(F.col("np") / MOST_POINTS).alias("pi")), "tiles")
    groups = pieces.agg(F.sum(F.col("qi") * F.col("pi"))).first()[0] or 1
    parts = int(max(1, min(groups, 4096, 1 + n // PARTITION_ROWS + groups // 4)))
    only = pieces.first() if all_ else None

    def spread(rows: DataFrame, own: str, other: str) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(0), (F.col(other) - 1).cast("int")))
        of = F.pmod(F.xxhash64(*axes, "id" if "id" in rows.columns else "other"), F.col(own)).cast("int")
        # All points are one tile, whose pieces are two numbers.
        rows = rows.withColumns({c: F.lit(only[c]) for c in ("qi", "pi")}) if only else rows.join(dealt(pieces), keys)
        return rows.withColumn("parts", F.col("pi")).withColumn(own, of).withColumn(other, copies).repartition(parts, *keys, "qi", "pi")

    def run(q, p):
        at, to = q[list(axes)].to_numpy(float), p[list(axes)].to_numpy(float)
        ids, places = np.unique(p["other"].to_numpy(), return_inverse=True)
        own = None
        if exclude_self:
            of = q["id"].to_numpy()
            place = np.minimum(np.searchsorted(ids, of), len(ids) - 1) if len(ids) else np.zeros(len(of), int)
            own = np.where(ids[place] == of, place, -1) if len(ids) else place - 1
        if not len(q) or not len(p):
            i, j, d2, rank = (np.zeros(0, t) for t in (int, int, float, int))
        else:
            i, j, d2, rank = _found(at, own, to, places, len(cell_axes), width, reach, k)
        worst = np.full(len(q), np.inf)
        full = rank == k
        worst[i[full]] = d2[full]
        out = {"id": q["id"].to_numpy()[i], "other": p["other"].to_numpy()[j], "d2": d2, "rank": rank.astype(np.int32)}
        out |= {c: p[c].take(j).array for c in payload} | {c: q[c].take(i).array for c in carried}
        out |= {"parts": q["parts"].to_numpy()[i], "sure": worst[i] <= reach * reach}
        return pd.DataFrame(out)

    kinds = dict(points.dtypes) | {c: dict(queries.dtypes)[c] for c in ("id", *carried)}
    schema = ", ".join([f"id {kinds['id']}", f"other {kinds['other']}", "d2 double", "rank int", *[f"`{c}` {kinds[c]}" for c in (*payload, *carried)], "parts long", "sure boolean"])
    group = [*keys, "qi", "pi"]
    return spread(asked, "qi", "pi").groupBy(*group).cogroup(spread(held, "pi", "qi").groupBy(*group)).applyInPandas(run, schema)


def nearest(queries: DataFrame, points: DataFrame, width: float | None = None, k: int = 1, axes: tuple[str, ...] = AXES, cell_axes: tuple[str, ...] | None = None, exclude_self: bool = False, payload: tuple[str, ...] = (), distinct: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """(id, other, d2, rank) for the k nearest points of each query; ties go to the lower id.

    queries and points have id and the axes; cells may use fewer axes than the distance does.
    width: of the first cells, by default found from the points. With exclude_self a point is
    not its own neighbour. payload, carried: columns of the points and of the queries that go along.
    distinct: the points come from distinct_places() already, as a table
    that may be read again. Queries with fewer than k points at all get what there is; places
    that are null or not finite are near nothing."""
    cell_axes = cell_axes or axes
    # The axes that cells use come first, where a task looks for them.
    axes = (*cell_axes, *[a for a in axes if a not in cell_axes])
    finite = " AND ".join(f"abs({a}) < double('infinity')" for a in axes)
    queries, points = written(queries.select("id", *axes, *carried).filter(finite), "queries"), points.select("id", *axes, *payload)
    if not distinct:
        points = written(distinct_places(points.filter(finite), axes, k + exclude_self), "places")
    box = points.select(*axes).withColumn("point", F.lit(1)).union(queries.select(*axes, F.lit(0))).agg(F.sum("point").alias("n"), *[(F.max(a) - F.min(a)).alias(a) for a in cell_axes]).first()
    span, n = float(max((box[a] or 0.0) for a in cell_axes)), box["n"] or 0
    width = width or cell_width(points, cell_axes, span, n, OCCUPANCY + k)
    out = None
    while True:
        last = REACH * width > span
        found = written(_candidates(queries, points, axes, cell_axes, width, k, exclude_self, payload, last, carried), "near")
        ranked = found.filter("parts = 1")
        if not found.filter("parts > 1").isEmpty():
            order = Window.partitionBy("id").orderBy("d2", "other")
            merged = found.filter("parts > 1").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            worst = F.max(F.when(F.col("rank") == k, F.col("d2"))).over(Window.partitionBy("id"))
            ranked = ranked.unionByName(written(merged.withColumn("sure", F.coalesce(worst <= (REACH * width) ** 2, F.lit(False))), "merged"))
        done = (ranked if last else ranked.filter("sure")).select("id", "other", "d2", "rank", *payload, *carried)
        out = done if out is None else out.union(done)
        if last:
            return out
        queries = written(queries.join(dealt(done.filter("rank = 1").select("id")), "id", "left_anti"), "queries")
        if queries.isEmpty():
            return out
        width *= REACH


def within_radius(queries: DataFrame, points: DataFrame, radius: float, axes: tuple[str, ...] = AXES) -> DataFrame:
    """(id, other, d2) of all points within the radius of a query."""
    return _pairs(queries, points, axes, axes, radius).filter(F.col("d2") <= radius * radius).select("id", "other", "d2")


def distance_summary(neighbours: DataFrame) -> DataFrame:
    """Mean, spread, root mean square, 95 % and largest of nearest distances."""
    d = F.sqrt("d2")
    p95 = quantiles(values_of(neighbours, d), [0.95])[0]
    return neighbours.agg(F.count("*").alias("n"), F.avg(d).alias("mean"), F.stddev_pop(d).alias("std"), F.sqrt(F.avg("d2")).alias("rms"), F.lit(p95).cast("double").alias("p95"), F.max(d).alias("max"))


def spacing(points: DataFrame, width: float | None = None, axes: tuple[str, ...] = AXES) -> DataFrame:
    """One row (spacing): median distance to the nearest other point, zeros left out."""
    d2 = nearest(points, points, width, axes=axes, exclude_self=True)
    return one_row(points, spacing=median(values_of(d2.filter("d2 > 0"), F.sqrt("d2"))))


def roughness(points: DataFrame, width: float | None = None, k: int = 16) -> DataFrame:
    """(id, residual): distance of each point to the plane through it and its k neighbours."""
    import numpy as np
    import pandas as pd

    near = nearest(points, points, width, k=k + 1)
    gathered = near.join(dealt(points.select(F.col("id").alias("other"), *AXES)), "other")
    query = points.select("id", *[F.col(a).alias(f"q{a}") for a in AXES])
    grouped = gathered.groupBy("id").agg(*[F.collect_list(a).alias(a) for a in AXES]).join(dealt(query), "id")

    def fit(batches):
        for pdf in batches:
            residual, sizes = np.zeros(len(pdf)), pdf["x"].map(len).to_numpy()
            for n in np.unique(sizes):
                rows = np.flatnonzero(sizes == n)
                p = np.stack([np.vstack(pdf[a].iloc[rows]) for a in AXES], axis=2)
                middle = p.mean(axis=1, keepdims=True)
                normal = np.linalg.svd(p - middle, full_matrices=False)[2][:, -1]
                residual[rows] = np.abs(((pdf[["qx", "qy", "qz"]].to_numpy()[rows] - middle[:, 0]) * normal).sum(axis=1))
            yield pd.DataFrame({"id": pdf["id"], "residual": residual})

    return grouped.mapInPandas(fit, "id long, residual double")
