"""The pipeline's stages, each on what the one before kept."""

from __future__ import annotations

import collections

import pytest

import corpus_pipeline as pipeline
from driftline.llm import pii_spans


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    words = [f"w{i:03d}" for i in range(400)]
    text = lambda k: " ".join(words[(k * 37 + 11 * n * n) % 400] for n in range(60))
    docs = [(i, text(i), "en", "a" if i % 2 else "b", 0) for i in range(120)]
    docs += [(200, text(3), "en", "a", 0), (201, text(3) + " more", "en", "c", 0), (202, text(3), "en", "a", 0), (202, text(3), "en", "a", 0)]
    docs += [(300 + i, text(i + 500) + " villain scoundrel", "en", "a", 0) for i in range(40)]
    docs += [(400 + i, f"menu of the site\n{text(i + 200)}", "en", "z", 0) for i in range(30)]
    docs += [(500, "mail joe@mail.example.com or +1 (415) 555-1234 " + text(950), "en", "a", 0), (501, None, None, None, None), (502, "", "en", "a", 0), (None, text(970), "en", "a", 0)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(path / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(120)] + [(300 + i, 1, 1) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES:
        docs = pipeline.written(stage(spark, docs, folder), name)
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == list(pipeline.COLUMNS)
    ids = lambda name: collections.Counter(r.doc_id for r in kept[name])
    every = [*range(120), 200, 201, 202, 202, *range(400, 430), 500, 501, 502, None]
    assert ids("toxicity") == collections.Counter(every)
    assert ids("line_dedup") == collections.Counter(every)
    assert all("menu of the site" not in (r.text or "") for r in kept["line_dedup"])
    first = [i for i in every if i not in (200, 201, 202)]
    assert ids("near_dedup") == collections.Counter(first) == ids("pii")
    by_id = {r.doc_id: r for r in kept["pii"]}
    assert by_id[500].text.startswith("mail <EMAIL> or <PHONE> ") and by_id[501].text is None and by_id[7].n_chars == len(by_id[7].text)
    assert ids("packing").keys() == set(first)
    sizes = collections.Counter()
    for r in kept["packing"]:
        sizes[r.sequence_id] += r.length
    assert all(n <= 1024 and n & (n - 1) == 0 for n in sizes.values())


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_masking_is_the_operators_own():
    assert pipeline.mask_pii is pii_spans.mask_pii
