"""Radius joins over latitude/longitude columns.

An equi-join on a grid cell followed by the exact distance test, so it shuffles on the
cell and never compares every site with every point. Cells that hold many rows are
salted on either side. Counts within a radius are in ``geotree``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kiosklake.functions.geo import (
    Grid, chord_limit, chord_sure, distance_between, half_chord_squared, with_vector,
)
from kiosklake.operators.ranking import top_per
from kiosklake.session import dealt

_CELL = ["_row", "_col"]
# Cells of this size or larger number under 5.2 million on the whole globe, which
# bounds every per-cell table and so makes it safe to broadcast.
_BROADCAST_CELL_M = 10_000.0


def located(df: DataFrame, at: tuple[str, str]) -> DataFrame:
    return df.filter(F.col(at[0]).isNotNull() & F.col(at[1]).isNotNull())


def _in_cells(df: DataFrame, at: tuple[str, str], grid: Grid) -> DataFrame:
    """Each row with the one cell it lies in."""
    df = df.withColumn("_row", grid.row(F.col(at[0])))
    df = df.withColumn("_columns", grid.columns_in(F.col("_row")))
    return df.withColumn("_col", grid.col(F.col(at[1]), F.col("_columns"))).drop("_columns")


def spread(df: DataFrame, at: tuple[str, str], grid: Grid, radius_m: float, row: str = "_row", col: str = "_col") -> DataFrame:
    """Each row once per cell its circle can touch (band, column, columns of the band)."""
    lat, lng = F.col(at[0]), F.col(at[1])
    df = df.withColumn("_reach", grid.lng_reach(lat, radius_m))
    df = df.withColumn(row, F.explode(grid.rows_near(lat, radius_m)))
    df = df.withColumn("_columns", grid.columns_in(F.col(row)))
    df = df.withColumn(col, F.explode(grid.cols_near(lng, F.col("_reach"), F.col("_columns"))))
    return df.withColumn(col, F.pmod(F.col(col), F.col("_columns"))).drop("_reach", "_columns")


def within(first: str, second: str, radius_m: float) -> Column:
    """Exact radius test, but for pairs that arithmetic alone shows to be too far or surely near."""
    chord = half_chord_squared(first, second)
    sure = chord <= chord_sure(radius_m)
    return (chord <= chord_limit(radius_m)) & (sure | (distance_between(first, second) <= radius_m))


def _hot_cells(df: DataFrame, name: str, rows: int, radius_m: float) -> DataFrame:
    """Cells with more than ``rows`` rows and how many parts to split them into."""
    hot = (
        df.groupBy(*_CELL)
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias(name))
        .filter(F.col(name) > 1)
    )
    return F.broadcast(hot) if radius_m >= _BROADCAST_CELL_M else hot


def radius_join(
    sites: DataFrame,
    points: DataFrame,
    radius_m: float,
    *,
    site_key: str,
    site_at: tuple[str, str],
    point_key: str,
    point_at: tuple[str, str],
    distance: str = "distance_m",
    rows_per_part: int = 2_000,
) -> DataFrame:
    """Pairs of a site and a point at most ``radius_m`` apart, with the distance.

    The two frames must not share column names. Each point lies in one cell, so
    no pair comes out twice.
    """
    grid = Grid(radius_m)
    vectors = [f"{side}{axis}" for side in ("_u", "_v") for axis in "xyz"]
    near = with_vector(located(sites, site_at), site_at, "_u")
    near = spread(near, site_at, grid, radius_m)
    placed = with_vector(_in_cells(located(points, point_at), point_at, grid), point_at, "_v")
    # A hot cell becomes site parts x point parts; each side is copied to the
    # other side's parts, so a part holds about rows_per_part rows of each and their
    # product of pairs at most.
    site_parts = _hot_cells(near, "_sp", rows_per_part, radius_m)
    point_parts = _hot_cells(placed, "_pp", rows_per_part, radius_m)

    def split(df: DataFrame, key: str, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        df = df.join(site_parts, _CELL, "left").join(point_parts, _CELL, "left")
        return (
            df.withColumn(mine, F.pmod(F.xxhash64(key), F.coalesce(F.col(own), F.lit(1))))
            .withColumn(
                theirs,
                F.explode(
                    F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1).cast("array<bigint>")
                ),
            )
            .drop("_sp", "_pp")
        )

    # pairs grow with the product of a part's rows, so parts are dealt by number and not by their few bytes
    part = [*_CELL, "_si", "_pi"]
    left = dealt(split(near, site_key, "_sp", "_pp", "_si", "_pi"), *part, times=1)
    right = dealt(split(placed, point_key, "_pp", "_sp", "_pi", "_si"), *part, times=1)
    return (
        left.join(right, part)
        .filter(within("_u", "_v", radius_m))
        .withColumn(distance, distance_between("_u", "_v"))
        .drop(*_CELL, "_si", "_pi", *vectors)
    )


def nearest_sites(
    sites: DataFrame,
    points: DataFrame,
    radius_m: float,
    k: int,
    *,
    site_key: str,
    point_key: str,
    **places,
) -> DataFrame:
    """The ``k`` nearest sites of every point, within the radius."""
    pairs = radius_join(
        sites, points, radius_m, site_key=site_key, point_key=point_key, **places
    )
    return top_per(pairs, [point_key], [F.col("distance_m"), F.col(site_key)], k)
