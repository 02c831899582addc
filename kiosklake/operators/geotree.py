"""Counts and random picks within a radius, by a tree of grid cells over the counted points.

The points of a position are counted, positions fall into cells, and a cell that holds more than
``MEASURED`` positions is cut into finer cells, level by level. A circle adds the count of every
cell that lies wholly inside it, leaves out those wholly beyond it, looks into the finer cells of
a dense one on its rim, and measures positions only in rim cells that hold few. So neither a count
nor a pick forms pairs of circles and points, and no circle measures more than ``MEASURED``
positions of a cell.

Points that are picked from are numbered once in the order of the tree, cells first. Every cell
and every position then is a stretch of numbers, and the n-th point within a circle is found from
the counts alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from kiosklake.functions.geo import Grid, cos_bounds, with_vector
from kiosklake.operators.geojoin import located, spread, within
from kiosklake.operators.ranking import numbered
from kiosklake.session import materialize

#: Positions of a cell that a circle may measure one by one.
MEASURED = 64
#: Cells per radius on the first level, finer cells per side of a cell on the next, most levels.
_FIRST, _FINER, _LEVELS = 2, 8, 6

_LAT, _LNG = "_plat", "_plng"
_PLACE = ["_slat", "_slng"]


@dataclass(frozen=True)
class Level:
    """Cells of one fineness: their grid and the names of a position's band and column in it."""

    grid: Grid
    row: str
    col: str


def _levels(radius_m: float) -> list[Level]:
    return [Level(Grid(radius_m / (_FIRST * _FINER**i)), f"_row{i}", f"_col{i}") for i in range(_LEVELS)]


@dataclass
class Tree:
    """Counted positions with their cells on every level they are cut to."""

    radius_m: float
    levels: list[Level]
    spots: DataFrame

    def keys(self, depth: int) -> list[str]:
        """The names that tell a cell of a level."""
        return [name for level in self.levels[: depth + 1] for name in (level.row, level.col)]

    def order(self) -> list[Column]:
        """Cells first, coarse to fine, then positions."""
        return [F.col(name) for name in [*self.keys(len(self.levels) - 1), _LAT, _LNG]]


def tree(points: DataFrame, at: tuple[str, str], radius_m: float) -> Tree:
    """Count the points of every position, and cut cells while any holds too many positions.

    Points without a position are left out. One small job a level says whether another is needed.
    """
    spots = located(points, at).groupBy(F.col(at[0]).alias(_LAT), F.col(at[1]).alias(_LNG)).agg(
        F.count(F.lit(1)).alias("_n")
    )
    spots = with_vector(spots, (_LAT, _LNG), "_v")
    made = Tree(radius_m, [], spots)
    for depth, level in enumerate(_levels(radius_m)):
        row = level.grid.row(F.col(_LAT))
        col = level.grid.col(F.col(_LNG), level.grid.columns_in(row))
        if depth:
            dense = cells.filter(F.col("_spots") > MEASURED).select(*made.keys(depth - 1), F.lit(True).alias("_dense"))
            cut = made.spots.join(dense, made.keys(depth - 1), "left")
            row, col = F.when(F.col("_dense"), row), F.when(F.col("_dense"), col)
        else:
            cut = made.spots
        cut = cut.withColumns({level.row: row, level.col: col}).drop("_dense")
        made = Tree(radius_m, [*made.levels, level], materialize(cut, "spots"))
        known = made.spots.filter(F.col(level.row).isNotNull())
        cells = known.groupBy(*made.keys(depth)).agg(F.count(F.lit(1)).alias("_spots"))
        most = cells.agg(F.max("_spots")).first()[0]
        if most is None or most <= MEASURED:
            break
    return made


def _cells(made: Tree, depth: int, measures: list[Column]) -> DataFrame:
    """The cells of a level, whether positions are measured in them, and what is added up of them."""
    last = depth == len(made.levels) - 1
    known = made.spots.filter(F.col(made.levels[depth].row).isNotNull())
    few = F.lit(True) if last else F.count(F.lit(1)) <= MEASURED
    return known.groupBy(*made.keys(depth)).agg(few.alias("_few"), *measures)


def parts_within(made: Tree, places: DataFrame, at: tuple[str, str], measures: dict[str, Column]) -> DataFrame:
    """The parts of every place's circle: whole cells, and measured positions in rim cells.

    ``places`` are read as distinct positions. ``measures`` are aggregates over positions,
    by name; the result has the place and the measures of each part.
    """
    radius_m = made.radius_m
    cos_min, cos_max = cos_bounds(F.col("_slat"), radius_m)
    # dealt to as many tasks as the session has: what follows is much work on few bytes
    tasks = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = located(places, at).select(F.col(at[0]).alias("_slat"), F.col(at[1]).alias("_slng"))
    rows = rows.repartition(tasks, *_PLACE).distinct()
    rows = with_vector(rows.withColumns({"_cos_min": cos_min, "_cos_max": cos_max}), tuple(_PLACE), "_u")
    carried = rows.columns
    found = []
    probes = spread(rows, tuple(_PLACE), made.levels[0].grid, radius_m, made.levels[0].row, made.levels[0].col)
    for depth, level in enumerate(made.levels):
        keys = made.keys(depth)
        cells = _cells(made, depth, [m.alias(name) for name, m in measures.items()])
        # below the first level a probe has the dense cell, and meets all cells in it
        probes = probes.join(cells, keys if depth == 0 else made.keys(depth - 1))
        cell = (F.col(level.row), F.col(level.col), level.grid.columns_in(F.col(level.row)))
        inside = level.grid.wholly_within(F.col("_slat"), F.col("_slng"), *cell, F.col("_cos_max"), radius_m)
        beyond = level.grid.wholly_beyond(F.col("_slat"), F.col("_slng"), *cell, F.col("_cos_min"), radius_m)
        probes = probes.withColumns({"_inside": inside, "_beyond": beyond})
        found.append(probes.filter("_inside").select(*_PLACE, *measures))
        rim = probes.filter(~F.col("_inside") & ~F.col("_beyond")).select(*carried, *keys, "_few")
        spots = made.spots.select(*keys, *[f"_v{axis}" for axis in "xyz"], _LAT, _LNG, *_plain(made.spots))
        measured = rim.filter("_few").join(spots, keys).filter(within("_u", "_v", radius_m))
        found.append(measured.groupBy(*_PLACE, _LAT, _LNG).agg(*[m.alias(name) for name, m in measures.items()]).select(*_PLACE, *measures))
        if depth < len(made.levels) - 1:  # what goes on into finer cells, a plan of its own
            probes = materialize(rim.filter(~F.col("_few")).drop("_few"), "rim")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def _plain(spots: DataFrame) -> list[str]:
    """Columns of positions that measures may read."""
    return [c for c in ("_n", "_start") if c in spots.columns]


def count_within(
    sites: DataFrame, points: DataFrame, radius_m: float, *, site_key: str, site_at: tuple[str, str],
    point_at: tuple[str, str], name: str = "nearby",
) -> DataFrame:
    """``(site_key, name)``: number of points within the radius of every site; 0 without a position."""
    made = tree(points, point_at, radius_m)
    parts = parts_within(made, sites, site_at, {"_n": F.sum("_n")})
    per_place = parts.groupBy(*_PLACE).agg(F.sum("_n").alias("_n"))
    keyed = sites.select(site_key, F.col(site_at[0]).alias("_slat"), F.col(site_at[1]).alias("_slng"))
    return keyed.join(per_place, _PLACE, "left").select(
        site_key, F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias(name)
    )


def pick_within(
    rows: DataFrame, items: DataFrame, radius_m: float, *, row_at: tuple[str, str], item_at: tuple[str, str],
    item_keys: list[str], draw: Column,
) -> DataFrame:
    """Every row with one item drawn from those within the radius of its position.

    ``draw`` is uniform in [0, 1) per row; all items are as likely. Items count in the order
    of the tree and then of ``item_keys``, which are unique. Rows without a position or an
    item in reach drop out. The frames share no column names.

    Distinct positions of rows walk the tree, so rows of one place share the work; a row meets
    the parts of its circle, whose number depends on the grid and not on the items.
    """
    made = tree(items, item_at, radius_m)
    at_spot = located(items, item_at).join(
        made.spots.select(F.col(_LAT).alias(item_at[0]), F.col(_LNG).alias(item_at[1]), *made.keys(len(made.levels) - 1)),
        list(item_at),
    )
    cells = [F.col(k) for k in made.keys(len(made.levels) - 1)]
    listed = numbered(at_spot, order=[*cells, *[F.col(c) for c in (*item_at, *item_keys)]], name="_number")
    starts = listed.groupBy(F.col(item_at[0]).alias(_LAT), F.col(item_at[1]).alias(_LNG)).agg(F.min("_number").alias("_start"))
    made = Tree(radius_m, made.levels, made.spots.join(starts, [_LAT, _LNG]))
    parts = parts_within(made, rows, row_at, {"_n": F.sum("_n"), "_start": F.min("_start")})
    parts = materialize(parts, "parts")  # added up, and met by the rows
    running = Window.partitionBy(*_PLACE).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
    reach = parts.groupBy(*_PLACE).agg(F.sum("_n").alias("_all"))
    placed = located(rows, row_at).withColumns({"_slat": F.col(row_at[0]), "_slng": F.col(row_at[1])})
    drawn = placed.join(reach, _PLACE).withColumn("_pick", F.floor(draw * F.col("_all")).cast("bigint"))
    chosen = drawn.join(parts, _PLACE).filter((F.col("_before") <= F.col("_pick")) & (F.col("_pick") < F.col("_before") + F.col("_n")))
    chosen = chosen.withColumn("_number", F.col("_start") + F.col("_pick") - F.col("_before"))
    kept = [c for c in rows.columns]
    return chosen.select(*kept, "_number").join(listed.select("_number", *[c for c in items.columns if c not in item_at]), "_number").drop("_number")
