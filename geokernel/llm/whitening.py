"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become integers, so counts, sums and products are exact: tasks add up small centred
integers, and the scatter n * sum(y y') - (sum y)(sum y)' is n * n times the covariance without
any rounding. Its characteristic polynomial is found prime by prime (reduction to Hessenberg form
modulo the prime, then the recurrence over leading blocks) and put together by Chinese
remaindering. All its roots are real, so the sign changes of the shifted polynomial count the roots
above a point exactly (Descartes); halving isolates the roots with their multiplicities and then
narrows them. A component is found in the null space of scatter - root by elimination with complete
pivoting and inverse iteration, in integers of several hundred bits; only what comes out is rounded.

What reaches the driver is a matrix of dimensions x dimensions; primes and roots are dealt to tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPONENTS = 32
#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Larger entries count as this one.
_LARGEST = 2.0**62
#: Sums travel as signed digits of so many bits, which longs can add up millions of times.
_DIGIT_BITS = 40
#: Bits that the roots are narrowed to, from the trace downwards, and further bits of eliminations.
ROOT_BITS, GUARD_BITS = 200, 256


@dataclass
class Whitening:
    """The fit over all vectors of one number of dimensions. shift: whole means (of x - OFFSET);
    rest: sums of what is left after them; vectors: a component a row; variances: falling."""

    n: int
    shift: list[int]
    rest: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = math.nan


def sound_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector (array<double>) of the rows whose vector is neither null nor empty and holds
    no null and no non-finite entry."""
    found = table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return found.filter(F.coalesce((F.size("vector") > 0) & finite, F.lit(False)))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, whole entries less OFFSET as doubles) for each number of dimensions."""
    column = batch["vector"]
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = np.clip(np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)), -_LARGEST, _LARGEST)
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, values[starts[rows][:, None] + np.arange(d)] if len(rows) < len(sizes) else values.reshape(-1, d)


def _less(y: np.ndarray, shift: list[int]) -> np.ndarray:
    """y - shift without rounding: doubles where they are exact, else Python's integers."""
    if max(np.abs(y).max(initial=0), *map(abs, shift)) < 2**52:
        return y - np.array(shift, float)
    return y.astype(np.int64).astype(object) - np.array(shift, object)


def _sum_of(y: np.ndarray) -> np.ndarray:
    if y.dtype != object and np.abs(y).max(initial=0) * len(y) >= 2**53:
        y = y.astype(np.int64).astype(object)
    return y.sum(axis=0) if y.dtype == object else y.sum(axis=0).astype(np.int64).astype(object)


def _products_of(y: np.ndarray) -> np.ndarray:
    """The upper triangle of y'y, row after row, exact."""
    d = y.shape[1]
    largest = int(np.abs(y).max(initial=0)) ** 2
    if y.dtype == object or largest >= 2**53:
        whole = y if y.dtype == object else y.astype(np.int64).astype(object)
        total = whole.T @ whole
    else:
        total, step = np.zeros((d, d), object), max(1, 2**53 // max(largest, 1))
        for at in range(0, len(y), step):
            total = total + (y[at : at + step].T @ y[at : at + step]).astype(np.int64)
    return total[np.triu_indices(d)]


def _digits(dims: int, values: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(dims, place, digit, amount) of all digits but zeros."""
    for place, value in enumerate(values):
        sign, left, digit = (-1 if value < 0 else 1), abs(int(value)), 0
        while left:
            if low := left & ((1 << _DIGIT_BITS) - 1):
                yield dims, place, digit, sign * low
            left, digit = left >> _DIGIT_BITS, digit + 1


def _exact_sums(vectors: DataFrame, amounts) -> dict[int, list[int]]:
    """The sums of amounts(matrix) over all vectors, by number of dimensions. A task sends one
    row for each digit; Spark adds them up."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, y in _matrices(batch):
                d = y.shape[1]
                found = amounts(y)
                sums[d] = sums[d] + found if d in sums else found
        rows = [row for d, values in sums.items() for row in _digits(d, values)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], ["dims", "place", "digit", "amount"])

    found = vectors.select("vector").mapInArrow(partial, "dims long, place long, digit long, amount long")
    sums: dict[int, dict[int, int]] = {}
    for r in found.groupBy("dims", "place", "digit").agg(F.sum("amount").alias("amount")).collect():
        places = sums.setdefault(r["dims"], {})
        places[r["place"]] = places.get(r["place"], 0) + (r["amount"] << (_DIGIT_BITS * r["digit"]))
    return {d: [places.get(k, 0) for k in range(max(places) + 1)] for d, places in sums.items()}


def primes_below(limit: int, count: int) -> list[int]:
    """The largest primes below the limit (at most 2^31), by a sieve of a growing window."""
    width = 64 * (count + 16)
    low = max(2, limit - width)
    small = np.ones(math.isqrt(limit) + 1, bool)
    small[:2] = False
    for p in range(2, math.isqrt(len(small)) + 1):
        if small[p]:
            small[p * p :: p] = False
    window = np.ones(limit - low, bool)
    for p in np.flatnonzero(small).tolist():
        window[max(p * p, -(-low // p) * p) - low :: p] = False
    found = (low + np.flatnonzero(window))[::-1].tolist()
    if len(found) < count:
        raise ValueError(f"fewer than {count} primes in the window below {limit}")
    return found[:count]


def polynomials_modulo(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """The characteristic polynomial of an integer matrix modulo each prime, constant term first."""
    d, many = len(matrix), np.arange(len(primes))
    p = np.array(primes, np.int64)
    p1, p2 = p[:, None], p[:, None, None]
    h = np.stack([(matrix % q).astype(np.int64) for q in primes])
    for k in range(d - 2):
        pivot = k + 1 + (h[:, k + 1 :, k] != 0).argmax(axis=1)
        h[many, pivot], h[many, k + 1] = h[many, k + 1], h[many, pivot]
        h[many, :, pivot], h[many, :, k + 1] = h[many, :, k + 1], h[many, :, pivot]
        inverse = np.array([pow(int(a), -1, q) if a else 0 for a, q in zip(h[:, k + 1, k], primes, strict=True)], np.int64)
        u = h[:, k + 2 :, k] * inverse[:, None] % p1
        h[:, k + 2 :, :] = (h[:, k + 2 :, :] - u[:, :, None] * h[:, k + 1, None, :] % p2) % p2
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * u[:, None, :] % p2).sum(axis=2)) % p1
    blocks = np.zeros((d + 1, len(primes), d + 1), np.int64)
    blocks[0, :, 0] = 1
    for k in range(1, d + 1):
        new = np.roll(blocks[k - 1], 1, axis=1) - h[:, k - 1, k - 1, None] * blocks[k - 1] % p1
        below = np.ones(len(primes), np.int64)
        for i in range(1, k):
            below = below * h[:, k - i, k - i - 1] % p
            new -= (below * h[:, k - 1 - i, k - 1] % p)[:, None] * blocks[k - 1 - i] % p1
        blocks[k] = new % p1
    return blocks[d]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact coefficients for a symmetric integer matrix without negative eigenvalues, constant
    term first. By the means of roots no coefficient exceeds C(d, k) (trace / d)^k; so many primes
    are taken that their product is larger than twice that."""
    d, trace = len(matrix), int(np.trace(matrix))
    bound = 2 * max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    primes = primes_below(2**31, bound.bit_length() // 30 + 1)
    entries = [[int(a) for a in row] for row in matrix]

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = polynomials_modulo(np.array(entries, object), batch["p"].tolist())
            yield pd.DataFrame({"p": batch["p"], "coefficients": found.tolist()})

    dealt = spark.createDataFrame([(q,) for q in primes], "p long").repartition(min(len(primes), 2 * spark.sparkContext.defaultParallelism))
    product, whole = math.prod(primes), [0] * (d + 1)
    for r in dealt.mapInPandas(reduce, "p long, coefficients array<long>").collect():
        q, others = r["p"], product // r["p"]
        unit = others * pow(others, -1, q)
        whole = [w + a * unit for w, a in zip(whole, r["coefficients"], strict=True)]
    whole = [w % product for w in whole]
    return [w - product if 2 * w > product else w for w in whole]


def roots_above(polynomial: list[int], point: int) -> int:
    """How many roots, with multiplicities, lie above the point; all roots have to be real."""
    c, d = list(polynomial), len(polynomial) - 1
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += point * c[j + 1]
    signs = [a > 0 for a in c if a]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def isolate(polynomial: list[int], top: int, most: int) -> list[tuple[int, int, int]]:
    """(low, high, multiplicity): intervals (low, high] of the largest roots above 0, falling;
    more than one root is in an interval only where it is a single unit wide."""
    open_, found = [(0, top, roots_above(polynomial, 0))], []
    while open_ and sum(f[2] for f in found) < most:
        low, high, inside = open_.pop()
        if inside == 1 or (inside and high - low == 1):
            found.append((low, high, inside))
        elif inside:
            middle = (low + high) // 2
            above = roots_above(polynomial, middle) - sum(f[2] for f in found)
            open_ += [(low, middle, inside - above), (middle, high, above)]
    return found


def narrow(polynomial: list[int], low: int, high: int) -> int:
    """The upper end of the unit interval that holds the one root in (low, high]."""

    def sign(x: int) -> int:
        value = 0
        for a in reversed(polynomial):
            value = value * x + a
        return (value > 0) - (value < 0)

    right = sign(high)
    while high - low > 1 and right:
        middle = (low + high) // 2
        if (s := sign(middle)) in (0, right):
            high, right = middle, s
        else:
            low = middle
    return high


def null_vectors(matrix: np.ndarray, count: int) -> list[list[float]]:
    """Orthonormal vectors of the null space that `count` dimensions of an (almost) singular
    integer matrix have, by complete pivoting and two steps of inverse iteration."""
    d, one = len(matrix), 1 << GUARD_BITS
    m = matrix * one
    rows, columns = np.arange(d), np.arange(d)
    for k in range(d - count):
        at = int(np.abs(m[k:, k:]).argmax())
        i, j = k + at // (d - k), k + at % (d - k)
        m[[k, i]], rows[[k, i]] = m[[i, k]], rows[[i, k]]
        m[:, [k, j]], columns[[k, j]] = m[:, [j, k]], columns[[j, k]]
        factors = m[k + 1 :, k] * one // m[k, k]
        m[k + 1 :, k + 1 :] -= factors[:, None] * m[k, None, k + 1 :] // one
        m[k + 1 :, k] = factors
    for k in range(d - count, d):  # nothing but rounding is left there
        m[k, d - count :] = 0
        m[k, k] = 1

    def solved(b: np.ndarray) -> np.ndarray:
        x = b[rows].copy()
        for k in range(d - count):
            x[k + 1 :] -= m[k + 1 :, k] * x[k] // one
        for k in range(d - 1, -1, -1):
            x[k] = (x[k] * one - (m[k, k + 1 :] * x[k + 1 :]).sum()) // m[k, k]
        out = np.zeros(d, object)
        out[columns] = x
        return out * one >> max(0, int(np.abs(out).max()).bit_length())

    basis: list[np.ndarray] = []
    for k in range(count):
        start = np.zeros(d, object)
        start[rows[d - count + k]] = one
        x = solved(solved(start))
        for _ in range(2):
            for u in basis:
                x = x - u * ((x * u).sum() // one) // one
        norm = math.isqrt(int((x * x).sum()))
        basis.append(x * one // norm)
    return [[int(a) / one for a in u] for u in basis]


def principal_components(spark: SparkSession, scatter: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, list[Fraction]]:
    """Unit eigenvectors (a row each) and eigenvalues of a symmetric integer matrix without
    negative eigenvalues, falling, as far as they are above zero. Roots that agree in the first
    ROOT_BITS bits below the trace count as one root with its multiplicity."""
    trace = int(np.trace(scatter))
    if not trace:
        return np.zeros((0, len(scatter))), []
    polynomial = characteristic_polynomial(spark, scatter)
    zeros = next(i for i, c in enumerate(polynomial) if c)
    places = max(0, ROOT_BITS - trace.bit_length())
    scaled = [c << (places * (len(polynomial) - 1 - i)) for i, c in enumerate(polynomial)][zeros:]
    intervals = [(str(low), str(high), count) for low, high, count in isolate(scaled, trace << places, most)]
    entries = [[int(a) for a in row] for row in scatter]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low, high, count in batch[["low", "high", "count"]].itertuples(index=False):
                root = narrow(scaled, int(low), int(high)) if count == 1 else int(high)
                shifted = np.array(entries, object) * (1 << places) - root * np.eye(len(entries), dtype=int).astype(object)
                yield pd.DataFrame({"root": str(root), "vector": null_vectors(shifted, int(count))})

    dealt = spark.createDataFrame(intervals, "low string, high string, count long").repartition(min(len(intervals), 2 * spark.sparkContext.defaultParallelism))
    found = [(int(r["root"]), list(r["vector"])) for r in dealt.mapInPandas(solve, "root string, vector array<double>").collect()]
    found = sorted(found, reverse=True)[:most]
    return np.array([v for _, v in found]), [Fraction(root, 1 << places) for root, _ in found]


def _centred(y: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exact: doubles, or Python's integers where doubles would round."""
    y = _less(y, model.shift)
    if y.dtype != object and model.n * np.abs(y).max(initial=0) + max(map(abs, model.rest)) >= 2**53:
        y = y.astype(np.int64).astype(object)
    return y * model.n - np.array(model.rest, y.dtype)


def _whitened(centred: np.ndarray, model: Whitening) -> np.ndarray:
    return (centred / model.n).astype(float) @ (model.vectors / np.sqrt(model.variances)[:, None]).T


def _identity_errors(vectors: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """Largest entry of |covariance of the whitened values - identity|. The values are centred
    already: they are projections of x - S/n."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, y in _matrices(batch):
                if (model := models.get(y.shape[1])) is not None:
                    w = _whitened(_centred(y, model), model)
                    sums[y.shape[1]] = sums.get(y.shape[1], 0) + w.T @ w
        rows = [(d, place, amount) for d, total in sums.items() for place, amount in enumerate(total.ravel().tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["dims", "place", "amount"])

    out = {d: 0.0 for d in models}
    found = vectors.select("vector").mapInArrow(partial, "dims long, place long, amount double")
    for r in found.groupBy("dims", "place").agg(F.sum("amount").alias("amount")).collect():
        i, j = divmod(r["place"], len(models[r["dims"]].variances))
        out[r["dims"]] = max(out[r["dims"]], abs(r["amount"] / models[r["dims"]].n - (i == j)))
    return out


def fit_whitening(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """The fit over every sound vector, by number of dimensions. Three passes over the table:
    sums, products of what is left after the whole means, covariance of the whitened values."""
    vectors, spark = sound_vectors(table, id_col, vector_col), table.sparkSession
    sums = _exact_sums(vectors, lambda y: np.concatenate([_sum_of(y), np.array([len(y)], object)]))
    counts = {d: values[d] for d, values in sums.items()}
    shifts = {d: [s // counts[d] for s in values[:d]] for d, values in sums.items()}
    # A last 1 stands for the count, so that sums of zeros are not missing.
    products = _exact_sums(vectors, lambda y: np.concatenate([_products_of(_less(y, shifts[y.shape[1]])), np.array([len(y)], object)])) if sums else {}
    models = {}
    for d, values in products.items():
        n, rest = counts[d], [s - counts[d] * m for s, m in zip(sums[d], shifts[d], strict=False)]
        scatter = np.zeros((d, d), object)
        scatter[np.triu_indices(d)] = values[:-1]
        scatter = np.triu(scatter) + np.triu(scatter, 1).T
        scatter = n * scatter - np.outer(np.array(rest, object), np.array(rest, object))
        vectors_, roots = principal_components(spark, scatter, components)
        trace = int(np.trace(scatter))
        models[d] = Whitening(n, shifts[d], rest, vectors_, np.array([float(r / n**2) for r in roots]), np.array([float(r / trace) for r in roots]))
    for d, error in _identity_errors(vectors, models).items():
        models[d].identity_error = error
    return models


def _exact_decimals(deviations: np.ndarray) -> pa.Array:
    if deviations.dtype != object:
        return pa.array(deviations.astype(np.int64)).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(int(v)) if v < 10**38 else None for v in deviations], pa.decimal128(38, 0))


def whiten(table: DataFrame, models: dict[int, Whitening], id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each sound vector and component: id, component, n, deviation, whitened,
    explained, identity_error.

    Dropped are vectors that are null, empty or hold null or non-finite entries. Vectors of each
    number of dimensions have a fit of their own. Components whose variance is zero are not
    returned, so a single vector, or equal ones only, give no rows; neither does an empty table.
    Rows that repeat an id or have none are rows like any other. Equal variances have an
    orthonormal basis of their space. deviation is decimal(38, 0), null beyond 38 digits; entries
    beyond 2^62 / 64 count as that. Other columns are not read."""
    vectors = sound_vectors(table, id_col, vector_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, y in _matrices(batch):
                model = models.get(y.shape[1])
                if model is None or not (k := len(model.variances)):
                    continue
                centred = _centred(y, model)
                whitened = _whitened(centred, model)
                if centred.dtype != object and y.shape[1] * np.abs(centred).max(initial=0) ** 2 >= 2**53:
                    fits = y.shape[1] * np.abs(centred).max() ** 2 < 2**62
                    centred = centred.astype(np.int64) if fits else centred.astype(np.int64).astype(object)
                deviations = _exact_decimals((centred * centred).sum(axis=1))
                each = np.repeat(np.arange(len(at)), k)
                same = lambda values: pa.array(np.tile(values, len(at)))
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].take(pa.array(at[each])), same(np.arange(1, k + 1, dtype=np.int32)), pa.array(np.full(len(each), model.n)), deviations.take(pa.array(each)), pa.array(whitened.ravel()), same(model.explained), pa.array(np.full(len(each), model.identity_error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = vectors.schema["id"].dataType.simpleString()
    found = vectors.mapInArrow(rows, f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    return found.withColumnRenamed("id", id_col)
