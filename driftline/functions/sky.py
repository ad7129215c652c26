"""Sphere geometry and sky-cell numbering as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftline.functions.scalar import as_column


def angular_distance(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance in degrees (haversine form, accurate for small angles)."""
    half_dec = F.sin(F.radians(dec2 - dec1) / 2)
    half_ra = F.sin(F.radians(ra2 - ra1) / 2)
    chord = half_dec * half_dec + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * half_ra * half_ra
    return F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), chord))))


def band_count(cell_deg: float) -> int:
    return max(1, math.ceil(180.0 / cell_deg))


def dec_band(dec: Column, cell_deg: float) -> Column:
    """Declination band 0..n-1 counted from the south pole."""
    band = F.floor((dec + 90.0) / F.lit(cell_deg)).cast("long")
    return F.greatest(F.lit(0), F.least(F.lit(band_count(cell_deg) - 1), band))


def slices_in_band(band: Column, cell_deg: float) -> Column:
    """Number of right-ascension slices of a band.

    Chosen at the edge nearer to a pole so that no slice is narrower than the
    cell size; a polar band ends up with a single slice.
    """
    south = band * F.lit(cell_deg) - 90.0
    edge = F.greatest(F.abs(south), F.abs(south + F.lit(cell_deg)))
    narrow = F.when(edge < 90.0, F.cos(F.radians(edge))).otherwise(F.lit(0.0))
    return F.greatest(F.lit(1), F.floor(narrow * 360.0 / F.lit(cell_deg)).cast("long"))


def sky_cell(ra: Column | str, dec: Column | str, cell_deg: float) -> Column:
    """Cell id of a position: declination band and right-ascension slice packed in one long."""
    ra, dec = as_column(ra), as_column(dec)
    band = dec_band(dec, cell_deg)
    slices = slices_in_band(band, cell_deg)
    index = F.floor(F.pmod(ra, F.lit(360.0)) * slices / 360.0).cast("long")
    return pack_cell(band, F.least(slices - 1, index))


def pack_cell(band: Column, index: Column) -> Column:
    return band * F.lit(1 << 32) + index
