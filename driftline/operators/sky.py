"""Cone search on right ascension and declination."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.sky import angular_distance, dec_band, pack_cell, sky_cell, slices_in_band
from driftline.functions.sky_tree import cone_ranges, in_ranges, tree_cell
from driftline.sources.sinks import write_columnar


def cone_search(stars: DataFrame, ra: float, dec: float, radius_deg: float) -> DataFrame:
    """Stars within a radius of one position.

    The declination bounds are plain comparisons, so a table sorted or
    partitioned by declination skips everything outside the band.
    """
    near = stars.filter(F.col("dec").between(dec - radius_deg, dec + radius_deg))
    distance = angular_distance(F.col("ra"), F.col("dec"), F.lit(float(ra)), F.lit(float(dec)))
    return near.withColumn("distance_deg", distance).filter(F.col("distance_deg") <= radius_deg)


def write_by_cell(stars: DataFrame, path: str, cell_deg: float) -> None:
    """Stars with their sky cell, in files of disjoint cell ranges."""
    located = stars.withColumn("cell", sky_cell("ra", "dec", cell_deg))
    write_columnar(located, path, cluster_by=["cell"], sort_by=["cell"], by_range=True)


def cone_search_cells(stored: DataFrame, ra: float, dec: float, radius_deg: float, cell_deg: float) -> DataFrame:
    """``cone_search`` on a table written by cell: only files and row groups of the cone's cells are read.

    The cells of one cone are few (its area over a cell's) and become plain range comparisons on the stored column.
    """
    center = stored.sparkSession.range(1).select(F.lit(float(ra)).alias("center_ra"), F.lit(float(dec)).alias("center_dec"))
    cells = sorted(r.cell for r in cells_of_cone(center, radius_deg, cell_deg).select("cell").distinct().collect())
    runs: list[list[int]] = []
    for cell in cells:
        if runs and cell == runs[-1][1] + 1:
            runs[-1][1] = cell
        else:
            runs.append([cell, cell])
    inside = F.lit(False)
    for low, high in runs:
        inside = inside | F.col("cell").between(low, high)
    return cone_search(stored.filter(inside), ra, dec, radius_deg).drop("cell")


def write_by_tree_cell(stars: DataFrame, path: str) -> None:
    """Stars with their nested cell, in files of disjoint ranges of cells; one layout for cones of every size."""
    located = stars.withColumn("cell", tree_cell("ra", "dec"))
    write_columnar(located, path, cluster_by=["cell"], sort_by=["cell"], by_range=True)


def cone_search_tree(stored: DataFrame, ra: float, dec: float, radius_deg: float, most: int = 64) -> DataFrame:
    """``cone_search`` on a table written by nested cell: at most ``most`` ranges of ids, whatever the radius."""
    near = stored.filter(in_ranges("cell", cone_ranges(ra, dec, radius_deg, most)))
    return cone_search(near, ra, dec, radius_deg).drop("cell")


def cells_of_cone(centers: DataFrame, radius_deg: float, cell_deg: float) -> DataFrame:
    """Each center repeated for every sky cell its cone can touch, in column ``cell``."""
    south = F.greatest(F.col("center_dec") - radius_deg, F.lit(-90.0))
    north = F.least(F.col("center_dec") + radius_deg, F.lit(90.0))
    bands = F.sequence(dec_band(south, cell_deg), dec_band(north, cell_deg))
    by_band = centers.select("*", F.explode(bands).alias("_band")).withColumn(
        "_slices", slices_in_band(F.col("_band"), cell_deg)
    )
    # Half-width in right ascension of the cone; a cone over a pole covers the full circle.
    spread = F.lit(math.sin(math.radians(radius_deg))) / F.cos(F.radians("center_dec"))
    over_pole = F.abs("center_dec") + radius_deg >= 90.0
    half = F.when(over_pole | (spread >= 1.0), F.lit(180.0)).otherwise(F.degrees(F.asin(spread)))
    per_degree = F.col("_slices") / 360.0
    first = F.floor((F.col("center_ra") - half) * per_degree - 1e-9).cast("long")
    last = F.floor((F.col("center_ra") + half) * per_degree + 1e-9).cast("long")
    index = F.sequence(first, F.least(last, first + F.col("_slices") - 1))
    return (
        by_band.select("*", F.explode(index).alias("_index"))
        .withColumn("cell", pack_cell(F.col("_band"), F.pmod("_index", F.col("_slices"))))
        .drop("_band", "_slices", "_index")
    )


def cone_join(stars: DataFrame, centers: DataFrame, radius_deg: float, cell_deg: float | None = None) -> DataFrame:
    """Stars within a radius of any of many centers (``center_ra``, ``center_dec``).

    Both sides meet on the sky cell. Cells are as wide as the radius, so a
    center is compared with its near neighbourhood only, never with all stars.
    A crowded cell makes a skewed join partition, which adaptive execution splits.
    """
    cell_deg = cell_deg or max(radius_deg, 0.01)
    located = stars.withColumn("cell", sky_cell("ra", "dec", cell_deg))
    pairs = located.join(cells_of_cone(centers, radius_deg, cell_deg), "cell").drop("cell")
    distance = angular_distance(F.col("ra"), F.col("dec"), F.col("center_ra"), F.col("center_dec"))
    return pairs.withColumn("distance_deg", distance).filter(F.col("distance_deg") <= radius_deg)
