"""Nested sky cells: a quad-tree on the six faces of a cube, numbered so that a cell's descendants are one range of ids.

A position is projected to the face it lies on, and the face's square is halved in both directions level by level. The id is
the face followed by two bits a level; the id of a cell at a lower level is a prefix. At the stored level 29 every cell
at any level is a range of ids, so a region of the sky is covered by a few ranges of mixed depth: wide cells inside it and
narrow ones along its edge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftline.functions.scalar import as_column

#: Level of stored ids: 3 + 2 * 29 bits.
LEVELS = 29
#: Cells that a cover may have for each range it is asked for; most of them follow each other.
CELLS_PER_RANGE = 4
_SIDE = 1 << LEVELS
# Masks and shifts that spread the bits of a 32-bit number to every second place.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread_bits(x: Column) -> Column:
    for shift, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def _step(u: Column) -> Column:
    """Place 0 to 2**29 - 1 of a face coordinate between -1 and 1."""
    return F.greatest(F.lit(0), F.least(F.lit(_SIDE - 1), F.floor((u + 1.0) / 2.0 * _SIDE))).cast("long")


def tree_cell(ra: Column | str, dec: Column | str) -> Column:
    """Id of the level-29 cell of a position in degrees; null for a null."""
    ra, dec = F.radians(as_column(ra)), F.radians(as_column(dec))
    x, y, z = F.cos(dec) * F.cos(ra), F.cos(dec) * F.sin(ra), F.sin(dec)
    ax, ay, az = F.abs(x), F.abs(y), F.abs(z)
    on_x, on_y = (ax >= ay) & (ax >= az), ay >= az
    side = F.when(on_x, F.struct(ax.alias("m"), (x < 0).alias("low"), F.lit(0).alias("axis"), y.alias("p"), z.alias("q")))
    side = side.when(on_y, F.struct(ay.alias("m"), (y < 0).alias("low"), F.lit(1).alias("axis"), z.alias("p"), x.alias("q")))
    side = side.otherwise(F.struct(az.alias("m"), (z < 0).alias("low"), F.lit(2).alias("axis"), x.alias("p"), y.alias("q")))

    def packed(s: Column) -> Column:
        face = (s.axis * 2 + s.low.cast("int")).cast("long")
        inside = F.shiftleft(_spread_bits(_step(s.p / s.m)), 1).bitwiseOR(_spread_bits(_step(s.q / s.m)))
        return F.shiftleft(face, 2 * LEVELS).bitwiseOR(inside)

    known = ra.isNotNull() & dec.isNotNull()
    return F.when(known, F.transform(F.array(side), packed)[0])


def _on_face(face: int, p: float, q: float) -> tuple[float, float, float]:
    """Unit vector of a face coordinate."""
    m = -1.0 if face % 2 else 1.0
    v = ((m, p, q), (q, m, p), (p, q, m))[face // 2]
    norm = math.sqrt(sum(c * c for c in v))
    return tuple(c / norm for c in v)


def _angle(a: tuple, b: tuple) -> float:
    cross = (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
    return math.atan2(math.sqrt(sum(c * c for c in cross)), sum(x * y for x, y in zip(a, b)))


class _Cell:
    """A cell at any level: its face, corner and width, and a circle around it."""

    def __init__(self, face: int, level: int, i: int, j: int):
        self.face, self.level, self.i, self.j = face, level, i, j
        width = 2.0 / (1 << level)
        low = (-1.0 + i * width, -1.0 + j * width)
        self.centre = _on_face(face, low[0] + width / 2, low[1] + width / 2)
        corners = [_on_face(face, low[0] + a * width, low[1] + b * width) for a in (0, 1) for b in (0, 1)]
        # A face cell is the convex hull of its corners, so the farthest corner bounds it.
        self.radius = max(_angle(self.centre, c) for c in corners)

    def children(self) -> Iterator[_Cell]:
        for a in (0, 1):
            for b in (0, 1):
                yield _Cell(self.face, self.level + 1, 2 * self.i + a, 2 * self.j + b)

    def ids(self) -> tuple[int, int]:
        """First and last level-29 id inside."""
        code = 0
        for k in range(self.level - 1, -1, -1):
            code = code << 2 | (self.i >> k & 1) << 1 | self.j >> k & 1
        shift = 2 * (LEVELS - self.level)
        first = (self.face << 2 * self.level | code) << shift
        return first, first + (1 << shift) - 1


def cone_ranges(ra: float, dec: float, radius_deg: float, most: int = 64) -> list[tuple[int, int]]:
    """At most ``most`` ranges of ids that cover a cone, in order.

    Cells wholly inside are taken as they are; of those on the edge the widest is split, up to CELLS_PER_RANGE cells for a
    range. Cells that follow each other are one range, and the ranges of the smallest gaps are joined until they are few
    enough. The work depends on ``most`` alone, not on the table or the cone.
    """
    a, d = math.radians(ra), math.radians(dec)
    centre = (math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d))
    radius = math.radians(radius_deg)
    slack = 1e-9  # positions are rounded when they are stored

    def met(cells) -> list[_Cell]:
        return [c for c in cells if _angle(centre, c.centre) <= radius + c.radius + slack]

    inside: list[_Cell] = []
    edge = met(_Cell(face, 0, 0, 0) for face in range(6))
    while edge:
        k = min(range(len(edge)), key=lambda n: (edge[n].level, n))
        if edge[k].level == LEVELS or len(inside) + len(edge) + 3 > max(6, CELLS_PER_RANGE * most):
            break
        for child in met(edge.pop(k).children()):
            whole = _angle(centre, child.centre) + child.radius <= radius
            (inside if whole else edge).append(child)
    ranges: list[tuple[int, int]] = []
    for first, last in sorted(c.ids() for c in inside + edge):
        if ranges and first == ranges[-1][1] + 1:
            ranges[-1] = (ranges[-1][0], last)
        else:
            ranges.append((first, last))
    gaps = sorted((ranges[k + 1][0] - ranges[k][1], k) for k in range(len(ranges) - 1))
    closed = {k for _, k in gaps[: max(0, len(ranges) - most)]}
    joined: list[tuple[int, int]] = []
    for k, (first, last) in enumerate(ranges):
        joined.append((joined.pop()[0], last) if k - 1 in closed else (first, last))
    return joined


def in_ranges(cell: Column | str, ranges: list[tuple[int, int]]) -> Column:
    """Whether an id lies in any of the ranges: plain comparisons, which skip files and row groups."""
    cell, found = as_column(cell), F.lit(False)
    for first, last in ranges:
        found = found | cell.between(first, last)
    return found
