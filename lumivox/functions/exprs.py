"""Column helpers shared by the operators; every one is a built-in expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

CHANNELS = ("c1", "c2", "c3", "c4")
#: The largest stored intensity.
U16 = 65535


def sat_u16(value: Column) -> Column:
    """Rounded (half away from zero) and clamped to the range of a stored voxel; null stays null."""
    return F.least(F.greatest(F.round(value), F.lit(0)), F.lit(U16)).cast("int")


def sub2ind(ny: int, nx: int, y: Column, x: Column, z: Column) -> Column:
    """1-based column-major index of a 1-based voxel position."""
    return y + (x - 1) * ny + (z - 1) * (ny * nx)


def ind2sub(ny: int, nx: int, index: Column) -> tuple[Column, Column, Column]:
    """The inverse of ``sub2ind``."""
    zero = index - 1
    whole = lambda c: F.floor(c).cast("long")
    return F.pmod(zero, F.lit(ny)) + 1, F.pmod(whole(zero / ny), F.lit(nx)) + 1, whole(zero / (ny * nx)) + 1


def euclid(a: list[Column], b: list[Column], weights: list[float] | None = None) -> Column:
    """Euclidean distance; ``weights`` scale the axes (voxel sizes)."""
    scale = weights or [1.0] * len(a)
    return F.sqrt(reduce(lambda s, t: s + t, [((p - q) * w) * ((p - q) * w) for p, q, w in zip(a, b, scale)]))


def hamming(a: Column, b: Column) -> Column:
    """Places at which two arrays differ; places beyond the shorter one differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1)), F.lit(0), lambda s, v: s + v)


def hamming_called(a: Column, b: Column) -> Column:
    """Places at which two arrays differ, of those that ``a`` calls (0: no call)."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.when((x != 0) & (x != y), 1).otherwise(0)), F.lit(0), lambda s, v: s + v
    )


def l1_normalize(values: Column) -> Column:
    """An array divided by its sum; an array of sum 0 becomes nulls."""
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + v.cast("double"))
    return F.transform(values, lambda v: F.try_divide(v.cast("double"), total))


def squared_distance(a: Column, b: Column) -> Column:
    """Sum of squared differences of two arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v.cast("double"))


def apply_affine(matrix: list[float], y: Column, x: Column, z: Column) -> tuple[Column, Column, Column]:
    """A row-major 3 x 4 transform of a point."""
    row = lambda k: matrix[4 * k] * y + matrix[4 * k + 1] * x + matrix[4 * k + 2] * z + matrix[4 * k + 3]
    return row(0), row(1), row(2)


def permute_bases(codes: Column, order: tuple[int, ...] = (2, 1, 4, 3)) -> Column:
    """Base k becomes order[k]; 0 (no call) stays."""
    table = F.array(*map(F.lit, order))
    return F.transform(codes, lambda c: F.when(c == 0, 0).otherwise(F.try_element_at(table, c)))


def clamp_shift(shift: Column, limit: float) -> Column:
    """A shift held within +-limit, its sign kept."""
    return F.greatest(F.lit(-limit), F.least(F.lit(limit), shift))


def fma(a: Column, b: Column, c: Column) -> Column:
    """a * b + c of doubles, rounded once; where a factor is beyond 2**996 or not finite, rounded twice."""

    def halves(x: Column) -> tuple[Column, Column]:
        far = x * 134217729.0
        high = far - (far - x)
        return high, x - high

    (ah, al), (bh, bl) = halves(a), halves(b)
    product = a * b
    lost = ((ah * bh - product) + ah * bl + al * bh) + al * bl  # a * b is product + lost
    total = product + c
    part = total - product
    rest = (product - (total - part)) + (c - part)  # product + c is total + rest
    once = total + (rest + lost)
    return F.when(F.isnan(once), total).otherwise(once)


def linear_percentile(ordered: Column, p: float) -> Column:
    """Percentile of a sorted array of doubles: position (n - 1) p between its values from 0; null if it has none.

    Between neighbours it is low * (1 - d) + high * d with the last step rounded once, as
    DuckDB's ``quantile_cont`` has it: channels that tie there tie here, to the last bit.
    """
    at = (F.size(ordered) - 1) * F.lit(float(p))
    low = F.floor(at)
    d = at - low
    share = F.when(d == 0, 0.0).otherwise(F.get(ordered, F.ceil(at).cast("int")) * d)  # an infinite value at d = 0 counts once
    return fma(F.get(ordered, low.cast("int")), 1 - d, share)


def midpoint_percentile(values: Column, p: float) -> Column:
    """Percentile of an array by mid-points: position n p + 0.5 between sorted values, held within 1..n."""
    ordered = F.array_sort(values)
    n = F.size(ordered)
    at = F.greatest(F.lit(1.0), F.least(n.cast("double"), n * p + 0.5))
    low = F.floor(at).cast("int")
    high = F.least(low + 1, n)
    value = F.element_at(ordered, low) + (at - low) * (F.element_at(ordered, high) - F.element_at(ordered, low))
    return F.when(n > 0, value)
