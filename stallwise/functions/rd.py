"""WGS84 to Rijksdriehoek by the published polynomial of Schreutelkamp and Strang van Hees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The reference point and the coefficients {(power of p, power of l): value}.
LAT0, LON0 = 52.15517440, 5.38720621
X0, Y0 = 155000.0, 463000.0
R = {
    (0, 1): 190094.945,
    (1, 1): -11832.228,
    (2, 1): -114.221,
    (0, 3): -32.391,
    (1, 0): -0.705,
    (3, 1): -2.340,
    (1, 3): -0.608,
    (0, 2): -0.008,
    (2, 3): 0.148,
}
S = {
    (1, 0): 309056.544,
    (0, 2): 3638.893,
    (2, 0): 73.077,
    (1, 2): -157.984,
    (3, 0): 59.788,
    (0, 1): 0.433,
    (2, 2): -6.439,
    (1, 1): -0.032,
    (0, 4): 0.092,
    (1, 4): -0.054,
}


def wgs84_to_rd(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Planar x and y in metres, within about half a metre of a full transformation."""
    p, l = (lat - F.lit(LAT0)) * 0.36, (lon - F.lit(LON0)) * 0.36

    def series(start: float, terms: dict[tuple[int, int], float]) -> Column:
        monomials = [reduce(lambda a, b: a * b, [p] * i + [l] * j, F.lit(c)) for (i, j), c in terms.items()]
        return reduce(lambda a, b: a + b, monomials, F.lit(start))

    return series(X0, R), series(Y0, S)


def request_point(lat: Column, lon: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Planar coordinates of a request: latitude and longitude when both are given, else x and y.

    A zero coordinate counts as missing; a request without both coordinates gives NULLs.
    """
    rx, ry = wgs84_to_rd(lat.cast("double"), lon.cast("double"))
    wgs = lat.isNotNull() & lon.isNotNull()
    px = F.when(wgs, rx).otherwise(x.cast("double"))
    py = F.when(wgs, ry).otherwise(y.cast("double"))
    present = (px != 0) & (py != 0)
    return F.when(present, px), F.when(present, py)
