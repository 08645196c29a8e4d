"""Web-Mercator rasterisation of segments into tile pyramids.

A segment's two ends become global bin ("plane") coordinates at a zoom
level; the path between them is drawn with one bin per x column
(``y = trunc((x - x1) * rise / run + y1)``), or one bin per row for a
vertical run. Steep paths therefore leave gaps, and consecutive segments
both count their shared end bin. Paths more than half the world apart are
wrapped round the antimeridian. Levels are exploded in the same job
(no job per level), bins are counted with partial aggregation, and dense
tiles are assembled per tile, a group bounded by 256 x 256 entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TILE_BINS
from ..functions.geo import mercator_pixel

TILE_SLOTS = TILE_BINS * TILE_BINS


def _levels(levels: int | Sequence[int]) -> Column:
    if isinstance(levels, int):
        if levels < 1:
            raise ValueError("max level must be >= 1")
        return F.sequence(F.lit(1), F.lit(levels))
    lv = sorted(set(int(x) for x in levels))
    if not lv or lv[0] < 0:
        raise ValueError("levels must be non-negative")
    return F.array(*[F.lit(x) for x in lv])


def plane_points(segments: DataFrame, levels: int | Sequence[int] = 1, plane_offset: int = 0,
                 velocity_limit: float = -1.0, velocity_decay: float | None = None) -> DataFrame:
    """Per (segment, level): integer plane coordinates ``x1, y1, x2, y2`` of
    both ends (y north-up), and ``world`` = bins across the world.

    ``plane_offset=1`` reproduces the legacy off-by-one (one bin north).
    ``velocity_decay`` (0 < d < 1) keeps a segment at level L only if
    ``velocity < d^(L-1) * velocity_limit`` (off by default)."""
    df = segments.select("alat", "alon", "blat", "blon", "velocity_kmh",
                         F.explode(_levels(levels)).alias("level"))
    if velocity_decay is not None and 0 < velocity_decay < 1 and velocity_limit >= 0:
        df = df.where(F.col("velocity_kmh")
                      < F.pow(F.lit(float(velocity_decay)), F.col("level") - 1) * float(velocity_limit))
    ax, ay = mercator_pixel(F.col("alat"), F.col("alon"), F.col("level"))
    bx, by = mercator_pixel(F.col("blat"), F.col("blon"), F.col("level"))
    world = (F.pow(F.lit(2.0), F.col("level").cast("double")) * TILE_BINS).cast("bigint")
    return df.select("level", world.alias("world"),
                     ax.alias("x1"), (ay + plane_offset).alias("y1"),
                     bx.alias("x2"), (by + plane_offset).alias("y2"))


def _wrap(a: Column, b: Column, world: Column) -> tuple[Column, Column]:
    """If the two values are more than half the world apart, move the larger
    one down by a world."""
    far = F.abs(a - b) > world * 0.5
    return (F.when(far & (a > b), a - world).otherwise(a),
            F.when(far & ~(a > b), b - world).otherwise(b))


def raster_plane(plane: DataFrame, precision: str = "exact") -> DataFrame:
    """Bins on the line between (x1, y1) and (x2, y2) -> ``level, world, x, y``.

    ``precision="exact"``: integer arithmetic, identical on every engine.
    ``precision="float32"``: the legacy single-precision line equation."""
    world = F.col("world")
    x1, x2 = _wrap(F.col("x1"), F.col("x2"), world)
    y1, y2 = _wrap(F.col("y1"), F.col("y2"), world)
    p = plane.select("level", "world", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    run = F.col("x2") - F.col("x1")
    rise = F.col("y2") - F.col("y1")
    vertical = run == 0
    lo = F.when(vertical, F.least("y1", "y2")).otherwise(F.least("x1", "x2"))
    hi = F.when(vertical, F.greatest("y1", "y2")).otherwise(F.greatest("x1", "x2"))
    # two explodes of at most TILE_BINS entries per array but the outer one, which
    # counts blocks: a path across the world at level 18 has 2^17 blocks, not 2^25 bins
    blocks = p.select("*", lo.alias("_lo"), hi.alias("_hi")).select(
        "*", F.explode(F.sequence(F.floor(F.col("_lo") / TILE_BINS), F.floor(F.col("_hi") / TILE_BINS))).alias("_b"))
    e = blocks.select("*", F.explode(F.sequence(F.greatest(F.col("_lo"), F.col("_b") * TILE_BINS),
                                                F.least(F.col("_hi"), F.col("_b") * TILE_BINS + TILE_BINS - 1)))
                      .alias("_s"))
    s = F.col("_s")
    if precision == "exact":
        e = e.withColumn("_num", (s - F.col("x1")) * (F.col("y2") - F.col("y1"))
                         + F.col("y1") * (F.col("x2") - F.col("x1"))).withColumn("_run", run)
        # integer division truncating toward zero (SQL ``div``)
        y_line = F.expr("CASE WHEN _run = 0 THEN NULL ELSE _num div _run END")
    elif precision == "float32":
        rise_f = rise.cast("float")
        run_f = run.cast("float")
        b = (F.col("y1").cast("float") - ((F.col("x1").cast("float") * rise_f).cast("float") / run_f).cast("float")).cast("float")
        y_line = (((s.cast("float") * rise_f).cast("float") / run_f).cast("float") + b).cast("float").cast("int").cast("bigint")
    else:
        raise ValueError("precision must be 'exact' or 'float32'")
    return e.select("level", "world",
                    F.when(vertical, F.col("x1")).otherwise(s).alias("x"),
                    F.when(vertical, s).otherwise(y_line).alias("y"))


def plane_to_bin(df: DataFrame) -> DataFrame:
    """Plane (x, y) -> (level, tile_x, tile_y, bin_x, bin_y); negative
    coordinates wrap by a world; bin y counts from the tile's top row."""
    world = F.col("world")
    x = F.when(F.col("x") < 0, F.col("x") + world).otherwise(F.col("x"))
    y = F.when(F.col("y") < 0, F.col("y") + world).otherwise(F.col("y"))
    return df.select(
        F.col("level").cast("int").alias("level"),
        F.floor(x / TILE_BINS).cast("bigint").alias("tile_x"),
        F.floor(y / TILE_BINS).cast("bigint").alias("tile_y"),
        F.pmod(x, F.lit(TILE_BINS)).cast("bigint").alias("bin_x"),
        ((TILE_BINS - 1) - F.pmod(y, F.lit(TILE_BINS))).cast("bigint").alias("bin_y"),
    )


def bin_hits(segments: DataFrame, levels: int | Sequence[int] = 1, plane_offset: int = 0,
             precision: str = "exact", velocity_limit: float = -1.0,
             velocity_decay: float | None = None) -> DataFrame:
    """One row per (segment, level, bin on its path)."""
    plane = plane_points(segments, levels, plane_offset, velocity_limit, velocity_decay)
    return plane_to_bin(raster_plane(plane, precision))


def bin_counts(hits: DataFrame) -> DataFrame:
    """Sparse tiles: hits per (level, tile, bin) (partial aggregation)."""
    return (hits.groupBy("level", "tile_x", "tile_y", "bin_x", "bin_y")
            .agg(F.count(F.lit(1)).alias("value")))


def dense_tiles(counts: DataFrame) -> DataFrame:
    """Dense tiles: ``level, tile_x, tile_y, bins`` with 65,536 doubles in
    row-major order (slot ``bin_x + bin_y * 256``), zeros filled.

    The sparse bins of one tile (at most 65,536) are sorted by slot and each
    is preceded by the run of zeros since the previous bin, so assembly is
    linear in the tile size."""
    slot = (F.col("bin_x") + F.col("bin_y") * TILE_BINS).cast("int")
    per_tile = (counts.select("level", "tile_x", "tile_y", F.struct(slot.alias("i"),
                              F.col("value").cast("double").alias("v")).alias("e"))
                .groupBy("level", "tile_x", "tile_y")
                .agg(F.array_sort(F.collect_list("e")).alias("es")))
    pieces = F.transform(
        F.col("es"),
        lambda e, i: F.concat(
            F.array_repeat(F.lit(0.0), e["i"] - F.when(i == 0, F.lit(-1)).otherwise(F.col("es")[i - 1]["i"]) - 1),
            F.array(e["v"])))
    tail = F.array_repeat(F.lit(0.0), (TILE_SLOTS - 1) - F.element_at(F.col("es"), -1)["i"])
    return per_tile.select("level", "tile_x", "tile_y",
                           F.concat(F.flatten(pieces), tail).alias("bins"))
