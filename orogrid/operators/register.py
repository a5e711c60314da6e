"""Iterative least-squares registration of one height grid to another (slope-based, after Nuth and Kääb)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orogrid.operators import focal, grid, resample, stats
from orogrid.plans.scratch import Rounds

#: Fewest pixels that a fit may rest on.
LEAST_POINTS = 10


@dataclass
class Registration:
    """Offsets (dz, dx, dy) and their errors, and the RMSE; None where no registration was found."""

    offset: tuple[float, float, float] | None
    error: tuple[float, float, float] | None
    rmse: float | None
    rounds: int
    fallback: bool = False


def shifted(moving: DataFrame, offset: tuple[float, float, float], cell: float, value: str = "z") -> DataFrame:
    """The moving grid at the pixels of the fixed one once the offset is taken out of it; null beyond it."""
    dz, dx, dy = offset
    if dx or dy:
        moving = resample.shift(moving, value, -dy / cell, dx / cell, "bilinear", value)
    return moving.withColumn(value, F.col(value) - dz)


def differences(fixed: DataFrame, moved: DataFrame, cell: float) -> DataFrame:
    """(rid, r, c, dz, sx, sy): difference to the fixed grid where there is one, and slopes of the moved one."""
    slopes = focal.gradient(moved, "z", cell, cell)
    both = slopes.select(*grid.KEY, "z", (-F.col("gx")).alias("sx"), F.col("gy").alias("sy")).join(fixed.select(*grid.KEY, F.col("z").alias("_ref")), list(grid.KEY))
    return both.withColumn("dz", F.col("z") - F.col("_ref")).where("dz is not null").select(*grid.KEY, "dz", "sx", "sy")


def step_table(fixed: DataFrame, moved: DataFrame, cell: float) -> DataFrame:
    """(rid, r, c, dz, sx, sy): difference to the fixed grid and slopes of the moved one, outliers left out."""
    return _fit_rows(differences(fixed, moved, cell))


def _fit_rows(both: DataFrame) -> DataFrame:
    return stats.outlier_filter(both, "dz").where("sx is not null and sy is not null").select(*grid.KEY, "dz", "sx", "sy")


def register(fixed: DataFrame, moving: DataFrame, cell: float = 1.0, guess: tuple[float, float, float] | None = None, hold: bool = False, most: float = 15.0, least_step: float = -0.001, rounds: int = 5) -> Registration:
    """Offset of `moving` (rid, r, c, z) against `fixed`, one raster each, on the same pixel grid (y falls with r).

    Each round moves the grid by the offset so far, compares, and fits the differences to the slopes;
    a round costs a few aggregates, whatever the size of the grids. Both grids and the differences of a
    round are written, so that no round computes the grids again. It stops when the RMSE falls by
    less than -least_step, and then keeps the round before. If that is the second round, or an offset
    exceeds `most`, the median difference alone is used; without common pixels there is no result.
    """
    keep = Rounds(fixed.sparkSession)
    fixed, moving = (Rounds(df.sparkSession).keep(df.select(*grid.KEY, "z")) for df in (fixed, moving))
    p, err = (guess or (0.0, 0.0, 0.0)), (0.0, 0.0, 0.0)
    now, now_err, best, best_rmse, median = p, err, None, None, None
    for it in range(1, rounds + 1):
        if max(abs(now[1]), abs(now[2])) > most:
            return _median_only(median, it, guess, fixed, moving, cell, hold, most, least_step, rounds)
        table = keep.keep(_fit_rows(keep.keep(differences(fixed, shifted(moving, now, cell), cell))))
        row = stats.solve(stats.normal_sums(table, "dz", "sx", "sy")).first()
        if row is None or row.n < LEAST_POINTS:
            return Registration(None, None, None, it)
        rmse = math.sqrt(row.syy / row.n)
        if it == 1 and guess is None:
            m = table.groupBy("rid").agg(F.stddev_pop("dz").alias("s")).join(stats.medians(table, "dz", "m"), "rid").first()
            about = table.agg(F.sqrt(F.avg((F.col("dz") - m.m) * (F.col("dz") - m.m)))).first()[0]
            median = (m.m, m.s / math.sqrt(row.n), about)
        if best_rmse is not None and rmse - best_rmse > least_step:
            if it == 2 and guess is None:
                return _median_only(median, it, guess, fixed, moving, cell, hold, most, least_step, rounds)
            break
        if best_rmse is not None and it == rounds:
            break
        best, best_rmse = (now, now_err), rmse
        if guess is not None and hold:
            break
        if row.b0 is None or row.s2e is None:
            break
        t = stats.t_quantile(1 - 0.32 / 2, row.n - 3)
        se = [t * math.sqrt(row.s2e * row[f"v{i}"]) for i in range(3)]
        now = (now[0] + row.b0, now[1] + row.b1, now[2] + row.b2)
        now_err = tuple(math.hypot(a, b) for a, b in zip(now_err, se, strict=True))
    return Registration(best[0], best[1], best_rmse, it) if best else Registration(None, None, None, it)


def _median_only(median, it, guess, fixed, moving, cell, hold, most, least_step, rounds) -> Registration:
    if median is None:
        if hold:
            return Registration(None, None, None, it)
        return register(fixed, moving, cell, None, False, most, least_step, rounds)
    return Registration((median[0], 0.0, 0.0), (median[1], 0.0, 0.0), median[2], it, True)
