"""Similarity operators against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from driftline.llm import shingle_join
from driftline.llm.common import components
from driftline.llm.rp_forest import vector_links
from driftline.llm.shingle_join import Bands, shingle_components


def roots(n, links):
    parent = {i: i for i in n}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in n}


def by_pairs(docs, width, percent):
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
    links = []
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if j < i and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links.append((i, j))
    root = roots(sets, links)
    return {i: (len(sets[i]), root[i]) for i in sets}


def families(seed, n_families=6, copies=25):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(2000)]
    docs = []
    for _ in range(n_families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([12, 25, 60, 150, 220]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 16))):
                at, kind = rng.randrange(len(words)), rng.random()
                if kind < 0.4:
                    words[at] = rng.choice(vocabulary)
                elif kind < 0.7:
                    del words[at]
                else:
                    words.insert(at, rng.choice(vocabulary))
            docs.append((len(docs), " ".join(words)))
            if rng.random() < 0.3:  # a chain: each further from the first
                base = words
    return docs


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_shingle_join_equals_all_pairs(frame, width, percent):
    docs = families(width)
    docs += [(len(docs) + k, t) for k, t in enumerate([None, "", " \n", "a", "a b", "a b", "A  b\n", "x " * 3000, "x " * 3001])]
    got = shingle_components(frame(docs, "doc_id long, text string"), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == by_pairs(docs, width, percent)


def test_shingle_join_edges(frame):
    rows = [(1, "a b c d", "z", 5), (1, "a b c d", "z", 5), (None, "a b c d", "z", 5), (None, "q", "z", 5), (4, None, None, None)]
    got = shingle_components(frame(rows, "doc_id long, text string, sig string, fp long"), 3, 90).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == sorted(
        [(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None), (4, 0, 4)], key=str
    )
    assert shingle_components(frame([], "doc_id long, text string", 1)).count() == 0


def with_nulls(docs, width, percent):
    """As by_pairs, of rows whose id may be null: rows are nodes, a component is named by its least id."""
    rows = by_pairs([(k, text) for k, (_, text) in enumerate(docs)], width, percent)
    least = {}
    for k, (n, root) in rows.items():
        if docs[k][0] is not None:
            least[root] = min(docs[k][0], least.get(root, docs[k][0]))
    return sorted(((docs[k][0], n, least.get(root)) for k, (n, root) in rows.items()), key=str)


@pytest.mark.parametrize("null_ids", [lambda k: k == 2, lambda k: k % 3 == 0, lambda k: True])
@pytest.mark.parametrize(("star", "part"), [(256, 500), (1, 3)])
def test_shingle_join_with_null_ids(frame, monkeypatch, null_ids, star, part):
    monkeypatch.setattr(shingle_join, "SMALL_STAR", star)
    monkeypatch.setattr(shingle_join, "STAR_PART", part)
    words = [f"w{i}" for i in range(80)]
    edits = [["x", *words[1:]], [*words[:79], "y"], words, ["x", *words[1:79], "y"]]
    docs = [(k, " ".join(w)) for k, w in enumerate(edits)] + [(k + 4, t) for k, t in families(7, 3, 20)]
    docs = [(None if null_ids(k) else k, t) for k, t in docs]
    got = shingle_components(frame(docs, "doc_id long, text string"), 3, 95).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == with_nulls(docs, 3, 95)


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_large_stars_equal_all_pairs(frame, monkeypatch, width, percent):
    monkeypatch.setattr(shingle_join, "SMALL_STAR", 3)
    monkeypatch.setattr(shingle_join, "STAR_PART", 4)
    docs = families(width + 10)
    got = shingle_components(frame(docs, "doc_id long, text string"), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == by_pairs(docs, width, percent)


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_heavy_stars_equal_all_pairs(frame, monkeypatch, width, percent):
    """Stars whose sets are too much for one task meet in their differences, the others in one task."""
    monkeypatch.setattr(shingle_join, "STAR_ELEMENTS", 900)
    docs = families(width + 20)
    got = shingle_components(frame(docs, "doc_id long, text string"), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == by_pairs(docs, width, percent)


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
@pytest.mark.parametrize("known", [0, 50, 50_000])
def test_crowded_buckets_equal_all_pairs(frame, monkeypatch, width, percent, known):
    """Members of crowded buckets meet in their rarest elements, however few elements are known as common."""
    monkeypatch.setattr(shingle_join, "CROWDED", 2)
    monkeypatch.setattr(shingle_join, "ORDER_ELEMENTS", known)
    docs = families(width + 30)
    got = shingle_components(frame(docs, "doc_id long, text string"), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == by_pairs(docs, width, percent)


def star_rows(monkeypatch):
    """Rows of each table of pairs of hub and member that is written from now on."""
    rows, write = [], shingle_join.written

    def counted(df, label):
        out = write(df, label)
        if label == "stars":
            rows.append(out.count())
        return out

    monkeypatch.setattr(shingle_join, "written", counted)
    return rows


def test_a_common_passage_makes_no_star(frame, monkeypatch):
    monkeypatch.setattr(shingle_join, "CROWDED", 16, raising=False)
    rows, passage = star_rows(monkeypatch), " ".join(f"p{k}" for k in range(60))
    docs = [(k, passage + "".join(f" x{k}.{i}" for i in range(30 + k % 5))) for k in range(500)]
    got = shingle_components(frame(docs, "doc_id long, text string"), 5, 80).collect()
    assert all(r.component_id == r.doc_id for r in got) and rows[0] <= len(docs)


def test_only_repeated_elements_leave_a_task(monkeypatch):
    """Of sets with a passage in common and elements of their own, the passage is counted and no other row is made."""
    sets = [np.concatenate([np.arange(60), 1000 * (k + 1) + np.arange(100)]) for k in range(400)]
    batch = pa.record_batch({"grams": pa.array([x.astype(np.int64).tobytes() for x in sets], pa.binary())})
    rows = pa.Table.from_batches(shingle_join._repeated(iter([batch]))).to_pydict()
    assert rows == {"element": list(range(60)), "n": [400] * 60}
    monkeypatch.setattr(shingle_join, "STAR_ELEMENTS", 9_000)
    parts = list(shingle_join._repeated(iter([batch])))
    # 57 sets at a time, and the last of the 400 alone, whose elements none of its part repeats
    assert len(parts) == 8 and sum(sum(p.column("n").to_pylist()) for p in parts) == 399 * 60
    assert sum(p.num_rows for p in shingle_join._repeated(iter([]))) == 0


def family(n, seed=1):
    """Copies of one text, each with a few words of its own; most have partners, some have none."""
    rng = random.Random(seed)
    base, docs = [f"w{k}" for k in range(150)], []
    for i in range(n):
        words = list(base)
        for k in range(rng.choice([1, 2, 2, 3, 4])):
            words[rng.randrange(150)] = f"own{i}.{k}"
        docs.append((i, " ".join(words)))
    return docs


def test_a_large_family_makes_no_pairs(frame, monkeypatch):
    """A star of several tasks hands on no pairs of its members, whose number would grow with its square."""
    monkeypatch.setattr(shingle_join, "SMALL_STAR", 40)
    pairs, possible = [], shingle_join._possible

    def counted(rows, *rest):
        pairs.append(rows.count())
        return possible(rows, *rest)

    monkeypatch.setattr(shingle_join, "_possible", counted)
    docs = family(300)
    got = shingle_components(frame(docs, "doc_id long, text string"), 5, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == by_pairs(docs, 5, 80)
    assert len(pairs) == 1, "pairs other than those of hub and member"


def test_members_of_large_stars_meet(frame, monkeypatch):
    """Any two of different labels meet, as one that asks and one that does not; a few apart from the rest cost few rows."""
    monkeypatch.setattr(shingle_join, "SMALL_STAR", 20)
    apart = {1: 200, 2: 10, 3: 0}
    rows = [(hub, 1000 * hub + k, k if k < n else 777, 1) for hub, n in apart.items() for k in range(200)]
    groups = {}
    for r in shingle_join._asked(frame(rows, "hub long, fp long, label long, n long")).collect():
        groups.setdefault((r.hub, r.block, r.part), []).append(r)
    met = {(x.fp, y.fp) for g in groups.values() for x in g for y in g if x.asks and not y.asks}
    want = {frozenset((x[1], y[1])) for x in rows for y in rows if x[0] == y[0] and x[2] != y[2]}
    assert want <= {frozenset(p) for p in met} and {hub for hub, _, _ in groups} == {1, 2}
    assert sum(len(g) for key, g in groups.items() if key[0] == 2) == 200 + 10 * 10


def test_small_star_makes_fewer_links_than_members():
    """Members of many components that all link with each other, and large sets that none links with."""
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[k % 9 :], rng.integers(0, 2**63, k % 7, dtype=np.uint64)])) for k in range(300)]
    sets += [np.unique(rng.integers(0, 2**63, 5_000, dtype=np.uint64)) for _ in range(20)]
    table = pa.table(
        {
            "hub": pa.array([1] * len(sets)), "fp": pa.array(range(len(sets))), "label": pa.array([k if k > 2 else 0 for k in range(len(sets))]),
            "n": pa.array([len(x) for x in sets]), "cells": pa.array([shingle_join.sketch(x).tobytes() for x in sets], pa.binary()),
            "grams": pa.array([x.tobytes() for x in sets], pa.binary()),
        }
    )
    links = shingle_join._small_stars(90)(table)
    assert links.num_rows == 297
    known = [(0, 1), (0, 2), *zip(links.column("a").to_pylist(), links.column("b").to_pylist(), strict=True)]
    assert set(roots(range(len(sets)), known).values()) == {0, *range(300, 320)}
    assert shingle_join._near_members(90)(table).column("fp").to_pylist() == list(range(300))


def test_sketches_bound_the_overlap():
    rng = np.random.default_rng(1)
    for size in (1, 50, 1_499, 1_500, 9_000):
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        for share in (0.0, 0.5, 0.95, 1.0):
            b = np.unique(np.concatenate([a[: int(share * size)], rng.integers(0, 2**63, 1 + size // 9, dtype=np.uint64)]))
            bound = shingle_join.overlap_bound(shingle_join.sketch(a), shingle_join.sketch(b))
            assert bound >= len(np.intersect1d(a, b))
    full = np.full(shingle_join.CELLS, 65_535, np.uint16)
    assert shingle_join.overlap_bound(full, full) > 10**12


@pytest.mark.parametrize("percent", [80, 90])
def test_partners_share_a_probed_signature(percent):
    rng = np.random.default_rng(percent)
    bands = Bands(percent)
    for size in (3, 9, 12, 40, 111, 300, 520):
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            gone = int(rng.integers(0, 1 + size * (100 - percent) // 100))
            b = a[gone:] if rng.random() < 0.5 else np.unique(np.concatenate([a[gone // 2 :], rng.integers(0, 2**63, gone // 2, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < percent * (len(a) + len(b) - both) or len(a) == len(b) == both:
                continue
            (x, p), (y, q) = (shingle_join.signatures(g, bands) for g in (a, b))
            assert set(x[p].tolist()) & set(y.tolist()) and set(y[q].tolist()) & set(x.tolist())


def test_bands_hold_every_partner():
    for percent in (80, 90):
        bands = Bands(percent)
        for size in range(1, 3000):
            partner = size * 100 // percent
            assert bands.of(partner) - bands.of(size) in (0, 1)
            # Equal sizes differ most: common elements c with 100 c >= percent (2 size - c).
            common = -(-2 * size * percent // (100 + percent))
            assert 2 * (size - common) <= bands.most_apart(bands.of(size))


@pytest.mark.parametrize("bound", [0, 200_000])
def test_components_of_a_path_a_star_and_a_ring(frame, monkeypatch, bound):
    monkeypatch.setattr("driftline.llm.common.ONE_TASK_EDGES", bound)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(300 + i, 300 + (i + 1) % 7) for i in range(7)]
    edges += [(None, 3), (5, 5)]
    got = {r.id: r.component_id for r in components(frame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)} | {300 + i: 300 for i in range(7)}
    assert got == want


def test_vectors_against_brute_force(frame):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 24))
    x = np.concatenate([c + s * rng.standard_normal((30, 24)) for c, s in zip(centres, rng.uniform(0.02, 0.35, 40), strict=True)])
    rows = [(i, [float(v) for v in vec], 1) for i, vec in enumerate(x)]
    rows += [(5000, rows[3][1], 1), (5001, [2 * v for v in rows[3][1]], 1), (5002, None, 1), (5003, [0.0] * 24, 1)]
    rows += [(5004, [float("nan")] * 24, 1), (5005, [float("inf")] + [1.0] * 23, 1), (5006, [1.0, 2.0], 1), (5007, [None] + [1.0] * 23, 1)]
    got = {r.vec_id: r for r in vector_links(frame(rows, "vec_id long, embedding array<double>, k int"), leaf=64).collect()}
    assert len(got) == len(rows)
    ids = [r[0] for r in rows[: len(x) + 2]]
    m = np.array([r[1] for r in rows[: len(x) + 2]])
    m /= np.linalg.norm(m, axis=1)[:, None]
    near = m @ m.T >= 0.95
    want = near.sum(axis=1) - 1
    found = np.array([got[i].n_links for i in ids])
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum()
    root = roots(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True) if a < b])
    assert all(root[got[i].component_id] == root[i] for i in ids)
    assert all(got[i].kept == (got[i].component_id == i) for i in ids)
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(5002, 5008))


@pytest.mark.parametrize("levels", [0, 2])
def test_vectors_in_leaves_too_large_to_split(frame, monkeypatch, levels):
    from driftline.llm import rp_forest

    monkeypatch.setattr(rp_forest, "MAX_LEAF", 40)
    monkeypatch.setattr(rp_forest, "MAX_EXTRA_LEVELS", levels)
    rng = np.random.default_rng(1)
    x = np.ones(16) + 0.01 * rng.standard_normal((150, 16))
    rows = [(i, [float(v) for v in vec]) for i, vec in enumerate(x)]
    got = rp_forest.vector_links(frame(rows, "vec_id long, embedding array<float>"), trees=2 if levels == 0 else 12).collect()
    assert {r.component_id for r in got} == {0}
    links = [r.n_links for r in got]
    assert set(links) == {149} if levels == 0 else max(links) <= 149 and sum(links) >= 0.9 * 149 * 150


@pytest.mark.parametrize("n", [12_000, 30_000])
def test_vectors_of_a_dense_group_keep_their_links(spark, tmp_path, n):
    rng = np.random.default_rng(6)
    x, centre, group = rng.standard_normal((n, 64)), rng.standard_normal(64), n // 3
    x[:group] = centre / np.linalg.norm(centre) + 0.015 * rng.standard_normal((group, 64))
    rows = pd.DataFrame({"vec_id": np.arange(n), "embedding": list(x.astype(np.float32))})
    rows.to_parquet(tmp_path / "vectors.parquet")
    got = vector_links(spark.read.parquet(str(tmp_path / "vectors.parquet"))).toPandas().set_index("vec_id").sort_index()
    m = np.stack(rows["embedding"]).astype(np.float64)
    m /= np.linalg.norm(m, axis=1)[:, None]
    want = np.concatenate([(m[at : at + 1000] @ m.T >= 0.95).sum(axis=1) - 1 for at in range(0, n, 1000)])
    found = got["n_links"].to_numpy()
    assert (want[:group] == group - 1).all() and (found <= want).all() and found.sum() >= 0.99 * want.sum()
    assert set(got["component_id"][:group]) == {0}


def test_vectors_of_several_dimensions(frame):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [1.0, 0.0, 0.0]), (5, [2.0, 0.1, 0.0]), (6, [1.0, 0.0, 0.0]), (7, [0.0, 0.0, 1.0]), (8, [5.0]), (9, [5.0]), (0, None)]
    got = vector_links(frame(rows, "vec_id long, embedding array<float>")).collect()
    want = {0: (0, 0), 1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (2, 4), 5: (2, 4), 6: (2, 4), 7: (0, 7), 8: (1, 8), 9: (1, 8)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want and len(got) == len(rows)


def test_vectors_edges(frame):
    empty = frame([], "vec_id long, embedding array<float>", 1)
    assert vector_links(empty).count() == 0
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0]), (8, None), (None, None)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_links(frame(rows, "vec_id long, embedding array<float>")).collect()), key=str)
    assert got == sorted([(None, 2, 7, False), (None, 2, 7, False), (7, 2, 7, True), (8, 0, 8, True), (None, 0, None, False)], key=str)
