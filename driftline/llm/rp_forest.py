"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits recursively along random directions; vectors close to a split go down both sides. The margin is a
distance, not a share: it follows from how far apart a pair at the threshold can be, so that one split parts such a pair
with the probability of PARTED at most, whatever the data. A split that would send most vectors down both sides is not
made; a dense group so stays whole. Trees are fitted on a bounded sample and every vector is routed down each of them.
Leaves that turn out too large are split further by the same rule, and what a split does not shrink is compared block by
block. Vectors are compared only within leaves, by cosine in double precision.

A leaf never emits pairs. A pair counts in the first leaf that both vectors share, so that the leaves' link counts add up,
and a leaf passes on its links as a spanning forest. Equal vectors are one node with a number of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import components, joined, ship, written

TREES = 12
LEAF = 256
#: Projected distance, in standard deviations of that of a pair at the threshold, which no split parts. A direction drawn
#: from the normal distribution projects a distance d to normal values of deviation d.
KEPT_APART = 1.5
#: Bound of the probability that one split parts a pair: the normal tails beyond KEPT_APART.
PARTED = 0.134
#: A split is made if the squared shares of its two sides add up to this at most (halves without spill: 0.5), and is tried
#: along so many directions.
SHRINKS = 0.85
TRIES = 3
#: Vectors that trees are fitted on. Recall is measured against brute force in the tests.
SAMPLE = 20_000
#: A leaf above this size is split again; what cannot be split is compared block by block.
MAX_LEAF = 2_000
MAX_EXTRA_LEVELS = 12
SEED = 20_240_607


def direction(seed: int, dim: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal(dim)


def half_margin(threshold: float) -> float:
    """Both sides of a split get what is nearer to it than this; a pair is parted only if projected twice as far apart."""
    return KEPT_APART * np.sqrt(max(2 - 2 * threshold, 0.0)) / 2


def fit_tree(sample: np.ndarray, depth: int, seed: int, margin: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Directions, thresholds, whether it is split, and the half margin of a tree, node i having children 2i + 1 and 2i + 2.

    The threshold is the middle quantile at which the two sides shrink most. A node of up to ``least`` sample vectors, or
    which no direction shrinks, is a leaf.
    """
    nodes, dim = 2**depth - 1, sample.shape[1]
    rng = np.random.default_rng(seed)
    directions, thresholds, split = np.zeros((nodes, dim)), np.zeros(nodes), np.zeros(nodes, bool)
    held = {0: np.arange(len(sample))}
    for node in range(nodes):
        inside = held.pop(node, None)
        if inside is None or len(inside) <= least:
            continue
        for _ in range(TRIES):
            u = rng.standard_normal(dim)
            x = sample[inside] @ u
            places = np.quantile(x, (0.3, 0.4, 0.5, 0.6, 0.7))
            work = [(x < t + margin).mean() ** 2 + (x > t - margin).mean() ** 2 for t in places]
            k = int(np.argmin(work))
            if work[k] <= SHRINKS:
                directions[node], thresholds[node], split[node] = u, places[k], True
                held[2 * node + 1], held[2 * node + 2] = inside[x < places[k] + margin], inside[x > places[k] - margin]
                break
    return directions, thresholds, split, margin


def route(tree: tuple, vectors: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every vector in every leaf it reaches."""
    directions, thresholds, split, margin = tree
    rows, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    ends = []
    for _ in range(depth):
        on = split[node]
        ends.append((rows[~on], node[~on]))
        rows, node = rows[on], node[on]
        off = np.einsum("ij,ij->i", vectors[rows], directions[node]) - thresholds[node]
        left, right = off < margin, off > -margin
        rows = np.concatenate([rows[left], rows[right]])
        node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
    ends.append((rows, node))
    return np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends])


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _route_all(forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, depth = forest.value
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _unit(_matrix(batch.column(1)))
            parts = []
            for t, tree in enumerate(trees):
                rows, leaf = route(tree, m, depth)
                parts.append((rows, leaf + (t << 40)))
            rows, cells = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            yield pa.record_batch({"id": batch.column(0).take(pa.array(rows)), "cell": pa.array(cells)})

    return run


def _project(dim: int, level: int):
    """Projections of each vector on the TRIES directions of its cell at this level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m, cells = _unit(_matrix(batch.column(2))), batch.column(1).to_numpy()
            x = np.zeros((TRIES, len(m)))
            for cell in np.unique(cells):
                own = cells == cell
                for k in range(TRIES):
                    x[k, own] = m[own] @ direction((int(cell) ^ SEED + TRIES * level + k) & 0x7FFFFFFFFFFFFFFF, dim)
            columns = {"id": batch.column(0), "cell": batch.column(1)}
            yield pa.record_batch(columns | {f"x{k}": pa.array(x[k]) for k in range(TRIES)})

    return run


def _split_large(cells: DataFrame, vectors: DataFrame, dim: int, margin: float) -> tuple[DataFrame, DataFrame]:
    """Cells all within MAX_LEAF, and those that do not get smaller. Each level is a distributed split at the mean."""
    small, large = cells.where(F.lit(False)), cells
    stuck = large.limit(0).withColumn("size", F.lit(0).cast("long"))
    tries = range(TRIES)
    for level in range(MAX_EXTRA_LEVELS):
        sizes = large.groupBy("cell").agg(F.count("*").alias("size"))
        big = written(sizes.where(F.col("size") > MAX_LEAF), "leaves")
        fits = large.join(big.select("cell"), "cell", "left_anti").select("id", "cell")
        small = small.union(fits)
        if big.isEmpty():
            return small, stuck
        own = large.join(big.select("cell"), "cell", "left_semi").join(vectors, "id").select("id", "cell", "v")
        x = written(own.mapInArrow(_project(dim, level), "id long, cell long, " + ", ".join(f"x{k} double" for k in tries)), "projected")
        means = x.groupBy("cell").agg(*[F.avg(f"x{k}").alias(f"m{k}") for k in tries])
        met = x.join(means, "cell")
        off = [F.col(f"x{k}") - F.col(f"m{k}") for k in tries]
        share = lambda c: F.avg(c.cast("double"))
        work = [F.pow(share(o < margin), 2) + F.pow(share(o > -margin), 2) for o in off]
        # The first direction that shrinks the cell, or none: then it is compared as it is.
        chosen = met.groupBy("cell").agg(F.count("*").alias("size"), *[w.alias(f"w{k}") for k, w in enumerate(work)])
        pick = F.coalesce(*[F.when(F.col(f"w{k}") <= SHRINKS, k) for k in tries])
        chosen = written(chosen.select("cell", "size", pick.alias("pick")), "choices")
        stuck = stuck.union(large.join(chosen.where("pick is null").select("cell", "size"), "cell").select("id", "cell", "size"))
        at = reduce(lambda out, k: F.when(F.col("pick") == k, off[k]).otherwise(out), tries, F.lit(None).cast("double"))
        met = met.join(chosen.where("pick is not null").select("cell", "pick"), "cell").select("id", "cell", at.alias("off"))
        sides = F.when(F.abs("off") < margin, F.array(F.lit(1), F.lit(2))).when(F.col("off") > 0, F.array(F.lit(2))).otherwise(F.array(F.lit(1)))
        large = met.select("id", F.explode(sides).alias("side"), "cell").select("id", F.xxhash64("cell", "side").alias("cell"))
        large = written(large, "cells")
    sizes = large.groupBy("cell").agg(F.count("*").alias("size"))
    big = sizes.where(F.col("size") > MAX_LEAF).select("cell", "size")
    stuck = stuck.union(large.join(big, "cell").select("id", "cell", "size"))
    return small.union(large.join(big.select("cell"), "cell", "left_anti").select("id", "cell")), stuck


def _earlier(lists, here: int) -> np.ndarray:
    """Bits of each vector: the leaves before this one that it shares with another vector of this one."""
    flat = np.concatenate([np.asarray(c, np.int64) for c in lists])
    row = np.repeat(np.arange(len(lists)), [len(c) for c in lists])
    row, flat = row[flat < here], flat[flat < here]
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[code] > 1
    number = np.cumsum(times > 1) - 1
    bits = np.zeros((len(lists), -(-max(int((times > 1).sum()), 1) // 64)), np.uint64)
    at = number[code[shared]]
    np.bitwise_or.at(bits, (row[shared], at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    return bits


def _compare(threshold: float):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """Links of one leaf, or of two blocks of a leaf: (id, n, root)."""
        n = len(frame)
        ids, copies = frame["id"].to_numpy(), frame["copies"].to_numpy()
        if not n:
            return pd.DataFrame({"id": ids, "n": ids, "root": ids})
        m = _unit(np.stack(frame["v"].to_numpy()).astype(np.float64))
        block = frame["block"].to_numpy()
        earlier = _earlier(frame["cells"].tolist(), key[0])
        count, label = np.zeros(n, np.int64), np.arange(n)
        for start in range(0, n, 512):
            near = m[start : start + 512] @ m.T >= threshold
            p, q = np.nonzero(near)
            p += start
            ok = p < q
            if key[1] != key[2]:  # two blocks: pairs inside a block are another task's
                ok &= block[p] != block[q]
            p, q = p[ok], q[ok]
            for at in range(0, len(p), 65_536):
                x, y = p[at : at + 65_536], q[at : at + 65_536]
                mine = ~(earlier[x] & earlier[y]).any(axis=1)
                x, y = x[mine], y[mine]
                count += np.bincount(x, copies[y], n).astype(np.int64) + np.bincount(y, copies[x], n).astype(np.int64)
                a, b = label[x], label[y]
                edges = np.unique(np.stack([a, b])[:, a != b], axis=1)
                parent = {k: k for k in np.unique(edges).tolist()}
                for u, v in edges.T.tolist():
                    joined(parent, u, v)
                if parent:
                    root = np.arange(n)
                    for k in parent:
                        r = k
                        while parent[r] != r:
                            r = parent[r]
                        root[k] = r
                    label = root[label]
        out = pd.DataFrame({"id": ids, "n": count, "root": ids[label]})
        return out[out["n"] > 0]

    return run


def vector_links(vectors: DataFrame, threshold: float = 0.95, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, ...).

    n_links counts the other rows at cosine ``threshold`` or more among those that share a leaf; component_id is the
    smallest vec_id reachable, kept says whether the row is it. Null and zero vectors, and those with null, NaN or infinite
    components, link with nothing. Vectors of different dimensions do not link; each dimension has a forest of its own, one
    after the other. Equal vectors always link. A row whose vec_id is null counts as a link of others, and gets its component's smallest id, or null (then it is
    not kept). Rows repeated with the same id count each. Other columns are ignored.
    """
    ship(vectors.sparkSession)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0)
    # -0.0 and 0.0 are the same component.
    rows = rows.withColumn("v", F.when(sound, F.transform("v", lambda x: x + F.lit(0.0))))
    narrow = dict(vectors.dtypes)["embedding"] == "array<float>"
    dims = sorted(r.d for r in rows.where("v is not null").select(F.size("v").alias("d")).distinct().collect())
    unlinked = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    linked = [_links(rows.where(F.size("v") == dim), dim, narrow, threshold, trees, leaf) for dim in dims]
    return reduce(DataFrame.union, linked, unlinked)


def _links(rows: DataFrame, dim: int, narrow: bool, threshold: float, trees: int, leaf: int) -> DataFrame:
    """As vector_links, of sound vectors (vec_id, v) of one dimension; at least one."""
    spark = rows.sparkSession
    keyed = rows.withColumn("k", F.xxhash64("v"))
    classes = keyed.groupBy("k", "v").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    # A class without any id still needs a number of its own; negative ones are free.
    classes = classes.withColumn("id", F.coalesce("least_id", -F.pmod("k", F.lit(2**62)) - 1))
    classes = written(classes, "classes")
    total = classes.count()
    picked = classes.select("k", "v").orderBy(F.xxhash64("k"), "k").limit(SAMPLE).select("v").toArrow()
    sample = _unit(_matrix(picked.column("v").combine_chunks()))
    depth = max(0, min(int(np.ceil(np.log2(max(1, total / leaf)))), int(np.log2(max(1, len(sample) / 16)))))
    margin, least = half_margin(threshold), leaf * len(sample) / total
    forest = spark.sparkContext.broadcast(([fit_tree(sample, depth, SEED + t, margin, least) for t in range(trees)], depth))
    nodes = classes.select("id", "v", "copies")
    cells = written(nodes.select("id", "v").mapInArrow(_route_all(forest), "id long, cell long"), "cells")
    small, stuck = _split_large(cells, nodes.select("id", "v"), dim, margin)
    whole = small.select("id", "cell", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("block"))
    # A leaf of b blocks is compared block pair by block pair: each vector goes to the b pairs that hold its block.
    n_blocks = F.ceil(F.col("size") / (MAX_LEAF // 2)).cast("int")
    blocked = stuck.select("id", "cell", n_blocks.alias("b"), F.pmod(F.xxhash64("id"), n_blocks).cast("int").alias("block"))
    blocked = blocked.select("id", "cell", "block", F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("o"))
    blocked = blocked.select("id", "cell", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block")
    placed = whole.union(blocked)
    own_cells = small.union(stuck.select("id", "cell")).groupBy("id").agg(F.collect_set("cell").alias("cells"))
    # Values that came as floats travel as floats; nothing is lost.
    sent = F.col("v").cast("array<float>") if narrow else F.col("v")
    full = nodes.withColumn("v", sent).join(own_cells, "id")
    tasks = placed.join(full, "id").select("cell", "i", "j", "block", "id", "copies", "v", "cells")
    found = tasks.groupBy("cell", "i", "j").applyInPandas(_compare(threshold), "id long, n long, root long")
    found = written(found, "links")

    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).select("id", F.col("component_id").alias("label"))
    known = classes.select("k", "v", "id", "least_id", "copies").join(links, "id", "left").join(labels, "id", "left")
    known = known.withColumn("label", F.coalesce("label", "id"))
    least = known.groupBy("label").agg(F.min("least_id").alias("component_id"))
    known = known.join(least, "label").select("k", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = keyed.join(known.withColumnRenamed("v", "w"), (keyed.k == known.k) & (F.col("v") == F.col("w")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
