"""Exact Jaccard self-join of shingle sets by universe partition, pigeonhole and one-deletion neighbourhoods.

Two sets at Jaccard similarity t or more differ in few elements. Sizes fall into bands so that a partner is in the same
band or the next; in band b two partners differ in at most H_b elements. The universe of shingle hashes is dealt over
H_b + 1 segments, so partners agree in at least one whole segment. A segment with few of a set's shingles is no evidence:
unrelated sets agree there. A set may therefore skip such a segment if it pays with a one-deletion neighbourhood in one
of the band's spare segments (agreeing there up to one element rules out two differences instead of one). Which segments
are worth skipping is a matter of cost: an exact segment of k shingles is expected to collide in proportion to RARITY**k,
a neighbourhood costs k + 1 probes with k - 1 shingles each.

Copies of a set share a fingerprint and travel as one node. A crowded bucket, of a passage or a line that many unrelated
sets hold, is dealt anew: its members meet in the rarest elements of their sets instead, by an exact prefix filter.
Buckets never become pairs: a first pass verifies each bucket against its best connected member, its hub. Members that are
still apart then meet inside tasks, which return links between components and no pairs. A large family of near copies is dealt
over several tasks first, which leaves few members apart; those meet all others, in blocks. Before any set moves, pairs are
judged by their sketches: cell counts of the elements, whose smaller ones add up to a bound of the overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import WordHash, batch_values, components, mixed, ship, text_rows, word_hashes, words_of, written

#: Collision rate per shingle of a segment, for the cost of an exact segment.
RARITY = 0.25
#: Segments of each band whose one-deletion neighbourhoods are indexed: one, and so many for each segment that is likely empty.
SPARE_PER_EMPTY = 5
#: Members from which a bucket is crowded. So many sets, at most about, tell which elements are common among those of crowded
#: buckets, and so many elements are known as common; both only order the elements, any order gives the same links.
CROWDED, ORDER_SETS, ORDER_ELEMENTS, ORDER_TASKS = 256, 5_000, 50_000, 8
#: Kinds of buckets and hubs.
HUB_KINDS = 8
#: Cells of a set's sketch, small and large, and the size from which sets have the large one.
CELLS, LARGE_CELLS, LARGE_SET = 128, 1024, 1_500
#: Members of a hub that one task compares with each other by their sketches, and elements of those whose whole sets it then
#: holds (8 bytes each), at most about; a larger star is several tasks', which compare blocks of members with parts of the star.
SMALL_STAR, STAR_ELEMENTS = 2_000, 2_000_000
#: Rows of a block and a part of a large star.
GROUP = ("hub", "block", "part", "fp", "label", "asks")
GROUP_TYPES = "hub long, block int, part int, fp long, label long, asks boolean"
#: Members of a hub whose whole sets one task holds at a time.
STAR_PART = 500
#: A broadcast of ids or pairs is asked for up to this many rows (16 to 32 bytes each); beyond, Spark joins by shuffle.
BROADCAST_ROWS = 1_000_000
_U = np.uint64


def shingles(memo: WordHash, text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a text of fewer words is one shingle, an empty one has none."""
    words = words_of(text)
    if not words:
        return np.empty(0, _U)
    h = word_hashes(memo, words)
    n = min(width, len(words))
    total = np.full(len(h) - n + 1, n, _U)
    for k in range(n):
        total = mixed(total + h[k : len(h) - n + 1 + k] + _U(k + 1))
    return np.unique(total)


def fingerprint(grams: np.ndarray) -> tuple[int, int]:
    """Two independent order-free 64-bit sums over a set."""
    first = mixed(grams + _U(0xA0761D6478BD642F)).sum(dtype=_U)
    second = mixed(grams ^ _U(0xE7037ED1A0B428DB)).sum(dtype=_U)
    return int(first.astype(np.int64)), int(second.astype(np.int64))


class Bands:
    """Size bands for a similarity of ``percent`` hundredths, computed in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]

    def of(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.low, size, "right")) - 1

    def most_apart(self, band: int) -> int:
        """Most elements in which two partners differ if the larger one is in ``band``."""
        while len(self.low) <= band + 1:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        largest = self.low[band + 1] - 1
        return (2 * largest * (100 - self.percent)) // (100 + self.percent)

    def spares(self, band: int, segments: int) -> int:
        """Segments whose neighbourhoods are indexed. A set of few shingles a segment leaves some empty, which is no evidence."""
        empty = segments * np.exp(-self.low[band] / segments)
        return min(segments - 1, 1 + int(np.ceil(SPARE_PER_EMPTY * empty - 0.5)))


def _allocate(counts: np.ndarray, spare: int) -> tuple[np.ndarray, list[int]]:
    """Segments probed exactly, and spare segments probed by neighbourhood, at least expected cost.

    Each spare segment that switches to its neighbourhood (cost (k + 1) * RARITY**(k - 1)) lets one other segment be skipped
    (saving RARITY**k); it does so where that is cheaper, the cheapest neighbourhoods first.
    """
    cost = RARITY ** counts.astype(float)
    probe = np.ones(len(counts), bool)
    deleted: list[int] = []
    nearby = (counts[:spare] + 1) * RARITY ** (counts[:spare].astype(float) - 1)
    for j in np.argsort(nearby, kind="stable").tolist():
        others = np.where(probe, cost, -1.0)
        others[[*deleted, j]] = -1.0
        worst = int(np.argmax(others))
        if probe[j] and counts[j] > 1 and others[worst] > nearby[j]:
            probe[worst] = False
            deleted.append(j)
    return probe, deleted


def signatures(grams: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of a set, and for each whether the set also probes by it."""
    keys, probes = [], []
    own = bands.of(len(grams))
    for band in (own, own + 1):
        apart = bands.most_apart(band)
        if apart == 0:
            continue  # only equal sets are partners, and those are one node
        m = apart + 1
        salt = _U((band * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        segment = ((mixed(grams + salt) >> _U(32)) % _U(m)).astype(np.int64)
        value = mixed(grams ^ salt)
        order = np.argsort(segment, kind="stable")
        counts = np.bincount(segment, minlength=m)
        sums = np.zeros(m, _U)
        present = np.flatnonzero(counts)
        starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
        sums[present] = np.add.reduceat(value[order], starts[present])
        place = mixed(np.arange(m, dtype=_U) + salt)
        spare = bands.spares(band, m)
        probe, deleted = _allocate(counts, spare)
        keys.append(mixed(sums + place))
        probes.append(probe)
        for j in range(spare):
            inside = value[order[starts[j] : starts[j] + counts[j]]]
            near = np.concatenate(([sums[j]], sums[j] - inside))
            keys.append(mixed(near + place[j] + _U(0x2545F4914F6CDD1D)))
            probes.append(np.full(len(near), j in deleted))
    if not keys:
        return np.empty(0, _U), np.empty(0, bool)
    return np.concatenate(keys), np.concatenate(probes)


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        for batch in batches:
            n, a, b = [], [], []
            for text in batch_values(batch, "text"):
                g = shingles(memo, text, width)
                x, y = fingerprint(g)
                n.append(len(g))
                a.append(x)
                b.append(y)
            ids = batch.column(0)
            yield pa.record_batch({"doc_id": ids, "n_shingles": pa.array(n, pa.int64()), "fp": pa.array(a, pa.int64()), "fp2": pa.array(b, pa.int64())})

    return run


def _index(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, bands, seen = WordHash(), Bands(percent), set()
        for batch in batches:
            sigs, nodes, probes, held = [], [], [], 0
            for text in batch_values(batch, "text"):
                g = shingles(memo, text, width)
                node = fingerprint(g)[0]
                if not len(g) or node in seen:  # a copy in the same task adds nothing
                    continue
                if len(seen) >= 500_000:
                    seen.clear()
                seen.add(node)
                keys, probe = signatures(g, bands)
                sigs.append(keys)
                probes.append(probe)
                nodes.append(np.full(len(keys), node, np.int64))
                held += len(keys)
                if held > 200_000:
                    yield _rows(sigs, nodes, probes)
                    sigs, nodes, probes, held = [], [], [], 0
            if sigs:
                yield _rows(sigs, nodes, probes)

    return run


def _rows(sigs: list, nodes: list, probes: list) -> pa.RecordBatch:
    return pa.record_batch({"sig": np.concatenate(sigs).astype(np.int64), "fp": np.concatenate(nodes), "probe": pa.array(np.concatenate(probes))})


def sketch(grams: np.ndarray) -> np.ndarray:
    """How many elements fall into each of CELLS cells, or LARGE_CELLS for a large set; counts above 65,535 stay there."""
    cells = CELLS if len(grams) < LARGE_SET else LARGE_CELLS
    counts = np.bincount((mixed(grams) & _U(cells - 1)).astype(np.int64), minlength=cells)
    return np.minimum(counts, 65_535).astype(np.uint16)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Most elements that sets with these sketches (rows) can share: the sum of the smaller counts of each cell.

    Of sketches of different width the wider one is folded. A full cell proves nothing and makes the bound endless.
    """
    width = min(a.shape[-1], b.shape[-1])
    a, b = (x.astype(np.int64).reshape(*x.shape[:-1], x.shape[-1] // width, width).sum(axis=-2) for x in (a, b))
    least = np.minimum(a, b)
    return np.where((least >= 65_535).any(axis=-1), np.iinfo(np.int64).max // 200, least.sum(axis=-1))


def _may_link(n_a: np.ndarray, n_b: np.ndarray, bound: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes link if they share as many elements as the bound and the sizes allow."""
    both = np.minimum(np.minimum(n_a, n_b), bound)
    return 100 * both >= percent * (n_a + n_b - both)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        for batch in batches:
            fps, packed, cells, n = [], [], [], []
            for text in batch_values(batch, "text"):
                g = shingles(memo, text, width)
                fps.append(fingerprint(g)[0])
                packed.append(g.tobytes())
                cells.append(sketch(g).tobytes())
                n.append(len(g))
            columns = {"fp": pa.array(fps, pa.int64()), "n": pa.array(n, pa.int64()), "cells": pa.array(cells, pa.binary())}
            yield pa.record_batch({**columns, "grams": pa.array(packed, pa.binary())})

    return run


def _held_twice(sets: list[np.ndarray]) -> pa.RecordBatch:
    values, n = np.unique(np.concatenate([np.empty(0, np.int64), *sets]), return_counts=True)
    return pa.record_batch({"element": values[n > 1], "n": n[n > 1]})


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements that several of a task's sets hold, and how many do; those of one set, which are most, do not leave the task."""
    sets, held = [], 0
    for batch in batches:
        for part in batch.column("grams"):
            sets.append(np.frombuffer(part.as_buffer(), np.int64))
            held += len(sets[-1])
            if held > STAR_ELEMENTS:
                yield _held_twice(sets)
                sets, held = [], 0
    yield _held_twice(sets)


def _common_elements(sets: DataFrame, n_sets: int) -> list[int]:
    """Elements that several of at most about ORDER_SETS sets hold, in one of ORDER_TASKS tasks, the rarest first; at most ORDER_ELEMENTS."""
    some = sets.where(F.pmod("fp", F.lit(-(-n_sets // ORDER_SETS))) == 0).select("grams").repartition(ORDER_TASKS)
    counts = some.mapInArrow(_repeated, "element long, n long").groupBy("element").agg(F.sum("n").alias("n"))
    return [r.element for r in counts.orderBy(F.desc("n"), "element").limit(ORDER_ELEMENTS).collect()][::-1]


def _rarest(common: list[int], percent: int):
    """Elements of which two sets that link have one in common: a set's first ones, the common ones after all others.

    Partners share at least ``percent`` hundredths of the larger set, so a set may leave out one element less than those.
    """
    values = np.array(common, np.int64).view(_U)
    order = np.argsort(values)
    known, rank = values[order], order + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for fp, x in zip(batch_values(batch, "fp"), batch.column(batch.schema.get_field_index("grams")), strict=True):
                g = np.frombuffer(x.as_buffer(), _U)
                if len(known):
                    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
                    g = g[np.argsort(np.where(known[at] == g, rank[at], 0), kind="stable")]
                prefix = g[: len(g) + percent * len(g) // -100 + 1]
                sigs.append(mixed(prefix + _U(0x6A09E667F3BCC909)).astype(np.int64))
                nodes.append(np.full(len(prefix), fp, np.int64))
            yield pa.record_batch({"sig": np.concatenate(sigs), "fp": np.concatenate(nodes)})

    return run


def _dealt_anew(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(sig, fp) of buckets that are not crowded; members of crowded ones in buckets of their rarest elements."""
    shared = buckets.where(F.col("members") <= CROWDED).select("sig", "fp")
    nodes = written(buckets.where(F.col("members") > CROWDED).select("fp").distinct(), "crowded")
    n = nodes.count()
    if n == 0:
        return shared
    sets = sets.join(_light(nodes, n), "fp", "left_semi").select("fp", "grams")
    keyed = sets.mapInArrow(_rarest(_common_elements(sets, n), percent), "sig long, fp long")
    by_key = Window.partitionBy("sig").orderBy("fp")
    met = keyed.select("sig", "fp", F.lag("fp").over(by_key).alias("before"), F.lead("fp").over(by_key).alias("after"))
    return shared.union(written(met.where("before is not null or after is not null").select("sig", "fp"), "anew"))


def _sketches(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint16) for x in column]


def _bounded(percent: int):
    """Pairs that their sketches do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bound = [int(overlap_bound(x, y)) for x, y in zip(_sketches(batch.column("cells_a")), _sketches(batch.column("cells_b")), strict=True)]
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            keep = _may_link(n_a, n_b, np.array(bound, np.int64), percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _linked(percent: int):
    """Links of one part of a hub's star: the hub's whole set comes once, then that of each member."""

    def run(key, members: pa.Table, hubs: pa.Table) -> pa.Table:
        kept = []
        if hubs.num_rows:
            p = np.frombuffer(hubs.column("hub_grams")[0].as_buffer(), _U)
            for row, y in enumerate(members.column("grams")):
                q = np.frombuffer(y.as_buffer(), _U)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    kept.append(row)
        return members.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return run


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that neither their sizes nor their sketches rule out; no set moves for this."""
    small = sets.select("fp", "n", "cells")
    both = pairs.join(small.toDF("a", "n_a", "cells_a"), "a").join(small.toDF("b", "n_b", "cells_b"), "b")
    fit = both.where(F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"))
    return fit.mapInArrow(_bounded(percent), "a long, b long")


def _light(rows: DataFrame, n: int) -> DataFrame:
    """Rows of ids, of which there are at most ``n``, marked for a broadcast where they are few: then no whole set moves to meet them."""
    return F.broadcast(rows) if n <= BROADCAST_ROWS else rows


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs that link by their whole sets.

    The members' sets travel to their hub, the hub's once to each part of its star of at most about STAR_PART members.
    """
    fit = written(_possible(pairs, sets, percent), "possible")
    n = fit.count()
    size = fit.groupBy("a").agg(F.ceil(F.count("*") / STAR_PART).cast("int").alias("parts"))
    salted = fit.join(size, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    members = _light(salted, n).join(sets.select(F.col("fp").alias("b"), "grams"), "b").select("a", "part", "b", "grams")
    hubs = _light(size, n).join(sets.select(F.col("fp").alias("a"), F.col("grams").alias("hub_grams")), "a")
    hubs = hubs.select(F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("hub_part"), "hub_grams")
    met = members.groupBy("a", "part").cogroup(hubs.groupBy("hub", "hub_part"))
    return met.applyInArrow(_linked(percent), "a long, b long")


def _folded(cells: list[np.ndarray]) -> np.ndarray:
    """Sketches of any width as rows of CELLS cells."""
    return np.minimum(np.stack([x.astype(np.int64).reshape(-1, CELLS).sum(axis=0) for x in cells]), 65_535).astype(np.uint16)


class _Star:
    """Members of one hub by growing size; rows of the table are in any order."""

    def __init__(self, table: pa.Table, percent: int):
        self.percent = percent
        n = table.column("n").to_numpy()
        self.order = np.argsort(n, kind="stable")
        self.n, self.labels = n[self.order], table.column("label").to_numpy()[self.order].copy()
        self.asks = table.column("asks").to_numpy()[self.order] if "asks" in table.column_names else None
        cells = _sketches(table.column("cells"))
        self.cells = [cells[k] for k in self.order.tolist()]
        self.folded = _folded(self.cells)
        self.last = np.searchsorted(self.n, self.n * 100 // percent, "right")  # partners by size end here

    def partners(self, i: int, wanted: np.ndarray | None = None) -> np.ndarray:
        """Later members of other labels, and of those in ``wanted``, that the sketches do not rule out as partners of ``i``.

        Where some members ask, only one that asks and one that does not are partners.
        """
        j = np.arange(i + 1, self.last[i])
        j = j[self.labels[j] != self.labels[i]]
        if self.asks is not None:
            j = j[self.asks[j] != self.asks[i]]
        if wanted is not None:
            j = j[wanted[j]]
        least = np.minimum(self.folded[j], self.folded[i])
        j = j[_may_link(self.n[j], self.n[i], least.sum(axis=1, dtype=np.int64), self.percent) | (least == 65_535).any(axis=1)]
        if len(j) and len(self.cells[i]) > CELLS:
            wide = np.array([len(self.cells[k]) == len(self.cells[i]) for k in j.tolist()])
            if wide.any():
                both = j[wide]
                bound = overlap_bound(np.stack([self.cells[k] for k in both.tolist()]), self.cells[i])
                j = np.concatenate([j[~wide], both[_may_link(self.n[both], self.n[i], bound, self.percent)]])
        return j


def _near_members(percent: int):
    """Members of one hub that have a partner in another component, as far as the sketches tell; a row each at most."""

    def run(table: pa.Table) -> pa.Table:
        star = _Star(table, percent)
        near = np.zeros(len(star.n), bool)
        for i in range(len(near) - 1):
            j = star.partners(i, ~near if near[i] else None)
            near[j] = True
            near[i] |= len(j) > 0
        return table.drop_columns(["cells"]).take(pa.array(np.sort(star.order[near])))

    return run


def _small_stars(percent: int):
    """Links by whole sets between members of one hub, of different components, until no two components of it link.

    Two components need one link: each is made one with the other at once, so there are fewer links than members.
    """

    def run(table: pa.Table) -> pa.Table:
        star = _Star(table, percent)
        fps, grams = table.column("fp").to_numpy()[star.order], table.column("grams")
        sets = [np.frombuffer(grams[k].as_buffer(), _U) for k in star.order.tolist()]
        left, right = [], []
        for i in range(len(sets) - 1):
            for j in star.partners(i).tolist():
                if star.labels[i] == star.labels[j]:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    left.append(fps[i])
                    right.append(fps[j])
                    star.labels[star.labels == star.labels[j]] = star.labels[i]
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return run


def _named(star: DataFrame, links: DataFrame) -> DataFrame:
    """(hub, fp, label) of the pairs of hub and member; the label is the component by these links, or the member itself."""
    label = components(links).select(F.col("id").alias("fp"), F.col("component_id").alias("label"))
    named = star.select(F.col("a").alias("hub"), F.col("b").alias("fp")).join(label, "fp", "left")
    return written(named.select("hub", "fp", F.coalesce("label", "fp").alias("label")), "members")


def _asked(members: DataFrame) -> DataFrame:
    """Members (hub, fp, label, n) of large stars as rows of GROUP, in which any two of one hub and different labels meet.

    Those without their star's most frequent label ask, dealt over blocks; all members answer, dealt over parts. A block
    meets each part once, so a star in which few members are still apart from the rest costs what it has members.
    """
    share = lambda count, elements: F.ceil(F.greatest(count / SMALL_STAR, elements / STAR_ELEMENTS)).cast("int")
    labels = members.groupBy("hub", "label").agg(F.count("*").alias("count"), F.sum("n").alias("elements"))
    stars = labels.groupBy("hub").agg(F.sum("count").alias("count"), F.sum("elements").alias("elements"), F.max(F.struct("count", "label", "elements")).alias("most"))
    blocks = share(F.col("count") - F.col("most.count"), F.col("elements") - F.col("most.elements")).alias("blocks")
    stars = stars.select("hub", F.col("most.label").alias("most"), blocks, share(F.col("count"), F.col("elements")).alias("parts")).where("blocks > 0")
    own, each = (lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")), (lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
    rows = members.join(stars, "hub")
    asking = rows.where("label <> most").select("hub", own("blocks").alias("block"), each("parts").alias("part"), "fp", "label", F.lit(True).alias("asks"))
    return asking.union(rows.select("hub", each("blocks").alias("block"), own("parts").alias("part"), "fp", "label", F.lit(False).alias("asks")))


def _links_across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that make one component of what links among the members (hub, fp, label) of a hub, however many there are."""
    met = _asked(members.withColumn("n", F.lit(1))).join(sets.select("fp", "n", "cells"), "fp").select(*GROUP, "n", "cells")
    near = met.groupBy("hub", "block", "part").applyInArrow(_near_members(percent), f"{GROUP_TYPES}, n long")
    near = written(near.select("hub", "fp", "label", "n").distinct(), "near")
    asked = written(_asked(near), "asked")
    whole = _light(asked, asked.count()).join(sets.select("fp", "n", "cells", "grams"), "fp").select(*GROUP, "n", "cells", "grams")
    return whole.groupBy("hub", "block", "part").applyInArrow(_small_stars(percent), "a long, b long")


def shingle_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text, ...).

    Two documents link when 100 * common shingles >= ``percent`` * all shingles of the two; component_id is the smallest
    doc_id reachable by links. Texts without words (null, empty) have no shingles and link with nothing, so they keep
    their own id; a row whose doc_id is null takes part by its text and gets the component's smallest id, or null.
    Repeated rows each return. Other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = text_rows(docs, F.col("doc_id").cast("long").alias("doc_id"))
    marks = written(rows.mapInArrow(_fingerprints(width), "doc_id long, n_shingles long, fp long, fp2 long"), "marks")
    classes = marks.where("n_shingles > 0").groupBy("n_shingles", "fp", "fp2").agg(F.min("doc_id").alias("least_id"))

    by_key = Window.partitionBy("sig").orderBy("fp")
    keyed = rows.select("text").mapInArrow(_index(width, percent), "sig long, fp long, probe boolean")
    placed = keyed.select("sig", "fp", "probe", F.lag("fp").over(by_key).alias("before"), F.lead("fp").over(by_key).alias("after"))
    buckets = placed.where("fp <> before or fp <> after").groupBy("sig", "fp").agg(F.max("probe").alias("probe"))
    whole = Window.partitionBy("sig")
    buckets = buckets.select("sig", "fp", F.max("probe").over(whole).alias("probed"), F.count("*").over(whole).alias("members"))
    buckets = written(buckets.where("probed").drop("probed"), "buckets")

    # Sets of the classes in buckets: rows with an id are found by it, those of classes that have none by their null id.
    wanted = classes.join(buckets.select("fp").distinct(), "fp", "left_semi").select(F.col("least_id").alias("doc_id")).distinct()
    wanted = written(wanted, "wanted")
    by_id = wanted.where("doc_id is not null")
    n_ids = by_id.count()
    if n_ids <= BROADCAST_ROWS:
        by_id = F.broadcast(by_id)
    once = marks.join(by_id, "doc_id", "left_semi").count() == n_ids
    found = rows.join(by_id, "doc_id", "left_semi").select("text")
    if wanted.where("doc_id is null").head(1):
        found = found.union(rows.where("doc_id is null").select("text"))
        once = False
    sets = found.mapInArrow(_sets(width), "fp long, n long, cells binary, grams binary").where("n > 0")
    # Where every wanted id is one row, as counted, each set is made once and need not meet others of its fingerprint.
    sets = written(sets if once else sets.dropDuplicates(["fp"]), "sets")

    # First pass: every member of a bucket against its hub, the one that shares most buckets. Buckets and members are of
    # HUB_KINDS kinds and a bucket prefers hubs of its own, so members of a family meet several hubs, but not one a bucket.
    shared = _dealt_anew(buckets, sets, percent)
    weight = shared.groupBy("fp").agg(F.count("*").alias("weight"))
    alike = F.pmod(F.xxhash64("sig"), F.lit(HUB_KINDS)) == F.pmod(F.xxhash64("fp"), F.lit(HUB_KINDS))
    hub = shared.join(weight, "fp").groupBy("sig").agg(F.max_by("fp", F.struct(alike, "weight", "fp")).alias("hub"))
    star = shared.join(hub, "sig").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()
    star = written(star, "stars")
    first = written(_verify(star, sets, percent), "links")

    # Second pass: members of one hub whose components still differ. The sketches tell whose sets must meet in one task, which
    # links them. A large star is dealt over several tasks, which leaves few of a family apart from the rest of it.
    named = _named(star, first)
    parts = F.ceil(F.count("*") / SMALL_STAR).cast("int").alias("parts")
    torn = named.groupBy("hub").agg(F.min("label").alias("low"), F.max("label").alias("high"), parts).where("low <> high")
    dealt = named.join(torn.select("hub", "parts"), "hub").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    dealt = dealt.join(sets.select("fp", "n", "cells"), "fp").select("hub", "part", "fp", "label", "n", "cells")
    near = written(dealt.groupBy("hub", "part").applyInArrow(_near_members(percent), "hub long, part int, fp long, label long, n long"), "near")
    heavy = near.groupBy("hub", "part").agg(F.sum("n").alias("elements")).where(F.col("elements") > STAR_ELEMENTS).select("hub", "part")
    light = _light(near.join(heavy, ["hub", "part"], "left_anti"), near.count()).join(sets.select("fp", "cells", "grams"), "fp")
    second = light.groupBy("hub", "part").applyInArrow(_small_stars(percent), "a long, b long")
    # Written, so that no task runs the workers of this step and of the next at once.
    links = first.union(written(second, "second"))

    # Third pass, of stars of several tasks: the members that are not of their star's largest component meet all others.
    large = written(torn.where("parts > 1").select("hub").union(heavy.select("hub")).distinct(), "large")
    if large.head(1):
        again = _named(star.join(large.select(F.col("hub").alias("a")), "a", "left_semi"), links)
        links = links.union(written(_links_across(again, sets, percent), "third"))

    label = components(links).select(F.col("id").alias("fp"), F.col("component_id").alias("label"))
    # Back to documents: equal sets are one class, linked classes one component.
    group = classes.join(label, "fp", "left").select("n_shingles", "fp", "fp2", "least_id", F.coalesce("label", "fp").alias("label"))
    least = group.groupBy("label").agg(F.min("least_id").alias("component_id"))
    ids = group.join(least, "label").select("n_shingles", "fp", "fp2", "component_id")
    out = marks.join(ids, ["n_shingles", "fp", "fp2"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
