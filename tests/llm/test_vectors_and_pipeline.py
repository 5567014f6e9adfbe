"""Embeddings and components against brute force, SQL twins, and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import EDGES, SCHEMA, prose, rows_of

import __spark_entry__ as entry
import corpus_pipeline
from catalog.compare import _kinds, _rows, connect
from wattline.llm import embedding_dedup, near_dedup
from wattline.llm.components import components
from wattline.llm.queries import ORACLES, QUERIES
from wattline.llm.tables import stored

SF_DIR = "/root/testdata/sf0.001"


def test_components_match_union_find(spark):
    rng = random.Random(0)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    links += [(500, i) for i in range(501, 600)]
    up = {n: n for pair in links for n in pair}

    def root(n: int) -> int:
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: root(n) for pair in links if pair[0] != pair[1] for n in pair}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def high(links):
    """Links ``u, v`` whose hashes are all so large that their sum, cut by 8 bits, passes 64 bits."""
    kept = stored(links.where(F.xxhash64("u", "v") > 1 << 62), "high")
    assert kept.count() > 512  # each is over 2 ** 54 then
    return kept


def test_components_of_links_with_large_hashes(spark):
    pairs = spark.range(10_000).select((F.col("id") * 2 + 1).alias("u"), (F.col("id") * 2).alias("v"))
    links = high(pairs)
    found = components(links, "u", "v").collect()
    assert sorted(map(tuple, found)) == sorted((n, v) for u, v in links.collect() for n in (u, v))


def near_texts(spark, setting):
    """Pairs of near copies, the ids of a pair 2i and 2i + 1, whose links have large hashes."""
    texts = [prose(i, 40) for i in range(3000)]
    rows = [(2 * i + k, t + (" another" if k else "")) for i, t in enumerate(texts) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    node = F.struct("lo", "c1", "c2")
    reps = near_dedup.classes(near_dedup.sketches(docs, setting))
    pairs = reps.groupBy(F.expr("lo div 2").alias("pair")).agg(F.max(node).alias("u"), F.min(node).alias("v"))
    return docs.join(high(pairs), F.expr("doc_id div 2 = pair"), "left_semi")


def test_near_duplicates_with_large_link_hashes(spark):
    setting = near_dedup.Setting()
    docs = near_texts(spark, setting)
    found = near_dedup.near_duplicates(docs, setting).select("id", "component_id").collect()
    assert len(found) == docs.count()
    assert all(r["component_id"] == r["id"] // 2 * 2 for r in found)


def test_the_pipeline_stage_with_large_link_hashes(spark):
    docs = near_texts(spark, corpus_pipeline.NEAR)
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, docs.where("doc_id % 2 = 0").collect()))


def test_vectors_with_large_link_hashes(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((3000, 32))
    near = base + rng.standard_normal(base.shape) * 0.05
    rows = [(2 * i + k, v[i].astype(np.float32).tolist()) for i in range(len(base)) for k, v in enumerate((base, near))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    node = F.struct(F.col("vec_id").alias("lo"), F.xxhash64("embedding").alias("h"))
    pairs = table.groupBy(F.expr("vec_id div 2").alias("pair")).agg(F.max(node).alias("u"), F.min(node).alias("v"))
    some = table.join(high(pairs), F.expr("vec_id div 2 = pair"), "left_semi")
    found = embedding_dedup.near_duplicates(some).collect()
    assert len(found) == some.count()
    assert all((r["n_links"], r["component_id"]) == (1, r["id"] // 2 * 2) for r in found)


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((700, 16))
    near = [base[0] + rng.standard_normal(16) * 0.25 for _ in range(600)]  # one dense leaf of several blocks
    near += [base[i] + rng.standard_normal(16) * 0.3 for i in range(1, 200)]
    vectors = [v.astype(np.float32).tolist() for v in [*base, *near]]
    rows = [(i, v, 1, 7) for i, v in enumerate(vectors)]
    rows += [(3, vectors[3], 2, 7), (None, vectors[3], 2, 7), (9001, None, 1, 7), (9002, [0.0] * 16, 1, 7), (9003, [float("nan")] * 16, 1, 7)]
    rows += [(9004, [None] + [1.0] * 15, 1, 7), (9005, [], 1, 7), (9006, [1e30] * 16, 1, 7), (9007, [1e30] * 16, 1, 7), (9008, [1.0] * 3, 1, 7)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links long")
    found = embedding_dedup.near_duplicates(table).collect()
    good = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) and len(r[1]) == 16]
    x = np.array([r[1] for r in good], np.float32).astype(float)
    x = x / np.abs(x).max(1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    want = sorted((r[0] is None, r[0] or 0, int(n)) for r, n in zip(good, linked.sum(1)))
    want += [(False, r[0], 0) for r in rows if r not in good]
    assert sorted((r["id"] is None, r["id"] or 0, r["n_links"]) for r in found) == sorted(want)
    label = np.array([np.inf if r[0] is None else r[0] for r in good])
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], np.inf).min(1))
        if (least == label).all():
            break
        label = least
    assert sorted(r["component_id"] for r in found) == sorted([*label.astype(int).tolist(), *(r[0] for r in rows if r not in good)])
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = connect(SF_DIR)
    ours, theirs = QUERIES[name](spark, SF_DIR).toArrow(), con.sql(ORACLES[name]).to_arrow_table()
    assert _kinds(ours) == _kinds(theirs)
    assert _rows(ours) == _rows(theirs)


def test_entry_has_all_queries():
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert "pipeline" in names


def test_pipeline_keeps_clean_and_drops_the_rest(spark, tmp_path):
    item = prose(900, 40)
    texts = list(EDGES) + [(600 + i, prose(600 + i, 50)) for i in range(60)]
    texts += [(700, f"{prose(700, 20)} {item} {prose(701, 20)}"), (701, f"{prose(702, 50)} mail me at a.b@c.org")]
    spark.createDataFrame(rows_of(texts), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, str(tmp_path)), "stage")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
    ids = {n: {r["doc_id"] for r in d.collect()} for n, d in seen.items()}
    clean = {600 + i for i in range(60)}
    assert clean <= ids["packing"] and not {4, 5, 6, 9} & ids["language"]
    assert {2, 3, 8} & ids["near_dedup"] == set() and {1, 7, 10, 11, 12} <= ids["near_dedup"]
    assert 700 in ids["near_dedup"] and 700 not in ids["decontamination"]
    text = {r["doc_id"]: r["text"] for r in seen["pii"].collect()}
    assert text[701].endswith("mail me at [EMAIL]") and text[601] == prose(601, 50)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_pipeline_takes_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_bands_follow_the_threshold():
    for setting in (near_dedup.Setting(), near_dedup.Setting(words=5, percent=80)):
        assert (1 - setting.threshold**setting.rows) ** setting.bands < setting.miss
