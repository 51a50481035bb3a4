"""Ordered operators that never need one whole group in one task.

A window over ``(sample, contig)`` would send a sample that holds a third of all rows to one task.
Here the ordered axis (a position, a length) is cut into fixed-width tiles, each tile is one window
group, and what must cross a tile border travels as one summary row per tile. A hot sample is thus
spread over as many tasks as it has tiles; the summary is smaller by the tile width.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = "_tile"
DEFAULT_WIDTH = 1 << 14


def tile_of(axis: Column, width: int) -> Column:
    return F.floor(axis / F.lit(width)).cast("bigint")


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    """Null-safe equality over ``keys``; still an equi-join for the planner."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def attach(df: DataFrame, summary: DataFrame, keys: Sequence[str], nulls: bool = True) -> DataFrame:
    """Left join of summary columns (unique per ``keys``) onto ``df``, NULL keys included.

    Without ``nulls`` (no key is NULL) rows that are dealt by ``keys`` already stay where they are; a null-safe test moves them.
    """
    extra = [c for c in summary.columns if c not in keys]
    if not nulls:
        return df.join(summary, list(keys), "left").select(*df.columns, *extra)
    joined = df.alias("l").join(summary.alias("r"), _same(keys, "l", "r"), "left")
    return joined.select("l.*", *[F.col(f"r.{c}").alias(c) for c in extra])


def carry(
    tiles: DataFrame, keys: Sequence[str], before: Mapping[str, Column], after: Mapping[str, Column] | None = None
) -> DataFrame:
    """Fold per-tile values over all earlier (``before``) or all later (``after``) tiles of a key.

    The values are unwindowed aggregate expressions such as ``F.max("end")``.
    """
    earlier = Window.partitionBy(*keys).orderBy(TILE).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(TILE).rowsBetween(1, Window.unboundedFollowing)
    columns = [value.over(earlier).alias(name) for name, value in before.items()]
    columns += [value.over(later).alias(name) for name, value in (after or {}).items()]
    return tiles.select(*keys, TILE, *columns)


def islands(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    slack: int = 0,
    width: int = DEFAULT_WIDTH,
    out: str = "island",
    nulls: bool = True,
) -> DataFrame:
    """Label runs of rows in which each starts at most ``slack`` after all earlier ends.

    ``out`` is the start of the run's first row, so a label means the same in every tile. Without ``nulls`` neither a key nor
    a start is NULL, and rows move once; not at all if they have their tile (by ``width``) already and are dealt by it.
    """
    tiled = df if TILE in df.columns else df.withColumn(TILE, tile_of(F.col(start), width))
    group = [*keys, TILE]
    in_tile = Window.partitionBy(*group).orderBy(start)
    # RANGE up to start - 1: rows of equal start never open a run against each other.
    seen = F.max(end).over(in_tile.rangeBetween(Window.unboundedPreceding, -1))
    opens = F.when(seen.isNull() | (F.col(start) - seen > slack), F.col(start))
    marked = tiled.withColumn("_open", opens).withColumn(
        "_here", F.max("_open").over(in_tile.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    )

    # In-tile openings rise along the tile, so if the latest lies behind the reach of the earlier
    # tiles it holds, and else none of them does.
    def holds(opening):
        return F.col("_reach").isNull() | (opening - F.col("_reach") > slack)

    tiles = marked.groupBy(*group).agg(F.max(end).alias("_end"), F.max("_open").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy(TILE).rowsBetween(Window.unboundedPreceding, -1)
    reached = tiles.withColumn("_reach", F.max("_end").over(earlier))
    last = F.when(holds(F.col("_last")), F.col("_last"))
    summary = reached.select(*group, "_reach", F.max(last).over(earlier).alias("_from"))
    joined = attach(marked, summary, group, nulls)
    label = F.when(holds(F.col("_here")), F.col("_here")).otherwise(F.col("_from"))
    return joined.withColumn(out, label).drop(TILE, "_open", "_here", "_reach", "_from")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    axis: str,
    values: Mapping[str, str],
    width: int = DEFAULT_WIDTH,
    descending: bool = False,
) -> DataFrame:
    """Running sums along ``axis`` (rows of one axis value count together), tile by tile."""
    tiled = df.withColumn(TILE, tile_of(F.col(axis), width))
    group = [*keys, TILE]
    totals = tiled.groupBy(*group).agg(*[F.sum(v).alias(f"_t_{o}") for o, v in values.items()])
    sums = {f"_c_{o}": F.sum(f"_t_{o}") for o in values}
    before = carry(totals, keys, {} if descending else sums, sums if descending else {})
    order = F.col(axis).desc() if descending else F.col(axis).asc()
    window = Window.partitionBy(*group).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = attach(tiled, before, group)
    for out, value in values.items():
        summed = summed.withColumn(
            out, F.sum(value).over(window) + F.coalesce(F.col(f"_c_{out}"), F.lit(0))
        )
    return summed.drop(TILE, *[f"_c_{o}" for o in values])


def next_value(
    df: DataFrame, keys: Sequence[str], axis: str, width: int = DEFAULT_WIDTH, out: str = "next"
) -> DataFrame:
    """The next axis value of the same key (axis values unique per key), across tile borders."""
    tiled = df.withColumn(TILE, tile_of(F.col(axis), width))
    group = [*keys, TILE]
    firsts = tiled.groupBy(*group).agg(F.min(axis).alias("_first"))
    following = carry(firsts, keys, {}, {"_next": F.min("_first")})
    lead = F.lead(axis).over(Window.partitionBy(*group).orderBy(axis))
    return attach(tiled, following, group).withColumn(out, F.coalesce(lead, F.col("_next"))).drop(TILE, "_next")


def halo(df: DataFrame, axis: str, reach: int, width: int) -> DataFrame:
    """Copy rows within ``reach`` of a tile border to the neighbour tile; ``_own`` marks the originals.

    Windows with a frame of at most ``reach`` can then run per tile with no other exchange.
    """
    if reach > width:
        raise ValueError("reach must not exceed the tile width")
    home = tile_of(F.col(axis), width)
    tiles = F.array_distinct(
        F.array(home, tile_of(F.col(axis) - reach, width), tile_of(F.col(axis) + reach, width))
    )
    spread = df.withColumn(TILE, F.explode(tiles))
    return spread.withColumn("_own", F.col(TILE) == home)
