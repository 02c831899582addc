"""Distance on the WGS84 ellipsoid and a latitude/longitude cell grid, as expressions.

Distances use the closed-form Andoyer-Lambert approximation (metre-level error
over the tens of kilometres used here), so they stay inside generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

EQUATOR_M = 6378137.0
FLATTENING = 1.0 / 298.257223563
# Shortest degree of latitude (at the equator) and a degree of longitude there:
# dividing by these never underestimates an angle.
LAT_DEGREE_M = 110574.0
LNG_DEGREE_M = 111319.0
# Longest degree of arc anywhere on the ellipsoid (at the poles).
MAX_DEGREE_M = 111700.0


def unit_vector(lat: Column, lng: Column) -> tuple[Column, Column, Column]:
    """A point as a unit vector on the reduced sphere; NULL when a coordinate is NULL.

    It depends on one point only, so joins add it to each side beforehand and no
    trigonometry is left per pair.
    """
    b = F.atan(F.tan(F.radians(lat)) * (1.0 - FLATTENING))
    turn = F.radians(lng)
    return F.cos(b) * F.cos(turn), F.cos(b) * F.sin(turn), F.sin(b) + turn * 0.0


def with_vector(df: DataFrame, at: tuple[str, str], prefix: str) -> DataFrame:
    """Add ``<prefix>x``, ``<prefix>y`` and ``<prefix>z`` for a position."""
    vector = unit_vector(F.col(at[0]), F.col(at[1]))
    return df.withColumns({f"{prefix}{axis}": v for axis, v in zip("xyz", vector)})


def half_chord_squared(first: str, second: str) -> Column:
    """Squared sine of half the central angle between two prefixed vectors."""
    gaps = [F.col(f"{first}{axis}") - F.col(f"{second}{axis}") for axis in "xyz"]
    return (gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2]) / 4.0


def chord_limit(radius_m: float) -> float:
    """No pair within the radius has a larger half chord squared."""
    return (radius_m / (2.0 * EQUATOR_M * (1.0 - 1.01 * FLATTENING))) ** 2 * 1.0001


def chord_sure(radius_m: float) -> float:
    """A pair of a half chord squared up to this is surely within the radius.

    Both corrections of the arc are taken off, so none is longer than on a sphere of the equator's radius.
    """
    return math.sin(min(radius_m / (2.0 * EQUATOR_M), math.pi / 2.0)) ** 2 * (1.0 - 1e-9)


def distance_between(first: str, second: str) -> Column:
    """Metres between two prefixed vectors."""
    return _metres(half_chord_squared(first, second), F.col(f"{first}z"), F.col(f"{second}z"))


def distance_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Metres between two points; NULL when a coordinate is NULL."""
    u, v = unit_vector(lat1, lng1), unit_vector(lat2, lng2)
    gaps = [a - b for a, b in zip(u, v)]
    c = (gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2]) / 4.0
    return _metres(c, u[2], v[2])


def _metres(c: Column, sin1: Column, sin2: Column) -> Column:
    """Andoyer-Lambert in half-angle form.

    Both correction terms need only the half chord and sums and differences of
    the sines of the reduced latitudes.
    """
    c = F.least(c, F.lit(1.0))
    root = F.sqrt(c)
    angle = F.asin(root) * 2.0
    sine = root * F.sqrt(F.lit(1.0) - c) * 2.0
    total, gap = sin1 + sin2, sin2 - sin1
    tiny = F.lit(1e-300)
    along = (angle - sine) * total * total / F.greatest(F.lit(1.0) - c, tiny)
    across = (angle + sine) * gap * gap / F.greatest(c, tiny)
    return (angle - (along + across) * (FLATTENING / 8.0)) * EQUATOR_M


class Grid:
    """Cells at least ``cell_m`` high and wide anywhere on the globe.

    Rows are bands of latitude. Each band has its own number of columns, fewer
    towards the poles, and columns wrap round the date line.
    """

    def __init__(self, cell_m: float):
        self.row_deg = cell_m / LAT_DEGREE_M
        self.col_deg = cell_m / LNG_DEGREE_M

    def row(self, lat: Column) -> Column:
        return F.floor((lat + 90.0) / self.row_deg).cast("int")

    def columns_in(self, row: Column) -> Column:
        """Number of columns in a band, from its edge nearest a pole."""
        middle = (row + 0.5) * self.row_deg - 90.0
        edge = F.least(F.abs(middle) + self.row_deg / 2.0, F.lit(90.0))
        return F.greatest(F.floor(F.cos(F.radians(edge)) * (360.0 / self.col_deg)), F.lit(1)).cast("int")

    def col(self, lng: Column, columns: Column) -> Column:
        return F.pmod(self._raw_col(lng, columns), columns)

    def _raw_col(self, lng: Column, columns: Column) -> Column:
        return F.floor((lng + 180.0) * columns / 360.0).cast("int")

    def rows_near(self, lat: Column, radius_m: float) -> Column:
        """Array of bands a circle round ``lat`` can touch."""
        reach = radius_m / LAT_DEGREE_M
        return F.sequence(
            self.row(F.greatest(lat - reach, F.lit(-90.0))),
            self.row(F.least(lat + reach, F.lit(90.0))),
        )

    def lng_reach(self, lat: Column, radius_m: float) -> Column:
        """Degrees of longitude a circle can span on either side; all of them near a pole."""
        top = F.abs(lat) + radius_m / LAT_DEGREE_M
        wide = radius_m / LNG_DEGREE_M / F.cos(F.radians(top))
        return F.when(top < 89.0, F.least(wide, F.lit(180.0))).otherwise(F.lit(180.0))

    def cols_near(self, lng: Column, reach: Column, columns: Column) -> Column:
        """Array of unwrapped column numbers the circle can touch, none twice round the globe."""
        low = self._raw_col(lng - reach, columns)
        return F.sequence(low, F.least(self._raw_col(lng + reach, columns), low + columns - 1))

    # Bounds on the distance from a point to the points of a cell. Straight lines in
    # degrees bound geodesics: longest where parallels are longest, shortest where
    # they are shortest, over the latitudes that lie within reach.

    def _offsets(self, lat: Column, lng: Column, row: Column, col: Column, columns: Column):
        dy = F.abs(lat + 90.0 - (row + 0.5) * self.row_deg)
        dx = F.abs(lng + 180.0 - (col + 0.5) * 360.0 / columns)
        return dy, F.least(dx, F.abs(F.lit(360.0) - dx)), F.lit(180.0) / columns

    def wholly_within(self, lat, lng, row, col, columns, cos_max: Column, radius_m: float) -> Column:
        """Every point of the cell is surely within the radius."""
        dy, dx, half = self._offsets(lat, lng, row, col, columns)
        y, x = dy + self.row_deg / 2.0, (dx + half) * cos_max
        limit = radius_m * 0.998 / MAX_DEGREE_M
        return y * y + x * x <= limit * limit

    def wholly_beyond(self, lat, lng, row, col, columns, cos_min: Column, radius_m: float) -> Column:
        """No point of the cell can be within the radius."""
        dy, dx, half = self._offsets(lat, lng, row, col, columns)
        zero = F.lit(0.0)
        y, x = F.greatest(dy - self.row_deg / 2.0, zero), F.greatest(dx - half, zero) * cos_min
        limit = radius_m * 1.002 / LAT_DEGREE_M
        return y * y + x * x > limit * limit


def cos_bounds(lat: Column, radius_m: float) -> tuple[Column, Column]:
    """Smallest and largest cosine of latitude a circle and the cells it touches can reach."""
    reach = 2.0 * radius_m / LAT_DEGREE_M
    low = F.greatest(F.abs(lat) - reach, F.lit(0.0))
    high = F.least(F.abs(lat) + reach, F.lit(90.0))
    return F.cos(F.radians(high)), F.cos(F.radians(low))
