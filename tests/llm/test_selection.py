"""Decontamination, quality, nearest neighbours."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimweave.llm import neighbours, quality, tiling

WORDS = [f"word{i}" for i in range(200)]


def words(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def plain_tiles(doc, item, least):
    """Greedy string tiling by comparing everything: the matched tokens."""
    free_d, free_i, total = [True] * len(doc), [True] * len(item), 0
    while True:
        best = None
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and free_d[d + n] and free_i[i + n]:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (d, i, n)
        if best is None:
            return total
        d, i, n = best
        free_d[d: d + n] = free_i[i: i + n] = [False] * n
        total += n


def test_tiles_match_brute_force():
    rng = random.Random(1)
    for _ in range(120):
        item = [rng.randrange(1, 6) for _ in range(rng.randrange(3, 40))]
        doc = [rng.randrange(1, 6) for _ in range(rng.randrange(0, 60))]
        at = rng.randrange(len(item))
        doc[3:3] = item[at:] + item[:at]
        tiles = tiling.greedy_tiles(np.array(doc), np.array(item), 3)
        for d, i, n in tiles:
            assert doc[d: d + n] == item[i: i + n]
        assert len({x for d, _, n in tiles for x in range(d, d + n)}) == sum(n for *_, n in tiles) == len({x for _, i, n in tiles for x in range(i, i + n)})
        assert sum(n for *_, n in tiles) == plain_tiles(doc, item, 3)


def test_long_runs_have_equal_hashes():
    ids = np.arange(200) % 50
    for size in (5, 32, 33, 60):
        hashes = tiling.window_hashes(ids, size)
        assert hashes[3] == hashes[53] != hashes[4]


def test_leaks_are_found_in_any_order(spark, documents):
    rng = random.Random(2)
    items = [(i, words(rng, 30)) for i in range(20)] + [(20, words(rng, 4))]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(21, None), (22, ""), (None, " ".join(words(rng, 12)))], "item_id long, text string")
    clean = [(i, " ".join(words(rng, 150))) for i in range(40)]
    whole = [(100 + i, " ".join([*words(rng, 20), *w, *words(rng, 20)])) for i, w in items[:20]]
    moved = [(200 + i, ", ".join([*w[20:], *words(rng, 9), *w[10:20], *words(rng, 2), *w[:10]]).upper()) for i, w in items[:20]]
    below = [(300 + i, " ".join([*words(rng, 9), *w[:14], *words(rng, 9)])) for i, w in items[:20]]
    short = [(400, " ".join(items[20][1])), (401, None), (402, ""), (None, whole[0][1])]
    docs = documents([*clean, *whole, *moved, *below, *short])
    got = {(r["doc_id"], r["item_id"]): r for r in tiling.leaks(docs, benchmark).collect()}
    want = {(b + i, i) for i in range(20) for b in (100, 200)} | {(None, 0)}
    assert set(got) == want
    assert all(r["coverage"] == 1.0 and r["matched"] == r["item_tokens"] == 30 for r in got.values())
    kept = tiling.without_leaks(docs.withColumn("item_id", F.lit(1)), benchmark)
    assert kept.columns == [*docs.columns, "item_id"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in [*clean, *below, *short[:3]]}
    assert tiling.leaks(docs.where("false"), benchmark).count() == 0
    assert tiling.leaks(docs, benchmark.where("false")).count() == 0
    assert tiling.without_leaks(docs, benchmark.where("false")).count() == docs.count()


def test_benchmark_of_several_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(tiling, "BLOCK_CHARS", 200)
    rng = random.Random(3)
    items = [(i, " ".join(words(rng, 20))) for i in range(10)]
    docs = documents(items + [(100, "clean")])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert tiling._blocks(benchmark)[1] > 3
    assert {(r["doc_id"], r["item_id"]) for r in tiling.leaks(docs, benchmark).collect()} == {(i, i) for i in range(10)}
    assert tiling.without_leaks(docs, benchmark).count() == docs.count() - 10
    assert [r["doc_id"] for r in tiling.without_leaks(docs, benchmark).collect()] == [100]


def test_rules_from_printed_trees():
    text = """Model
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 0 <= 0.25)
      Predict: 0.0
     Else (feature 0 > 0.25)
      Predict: 1.0
    Else (feature 0 > 0.5)
     Predict: 1.0
"""
    a = quality.NAMES[0]
    assert quality.tree_rules(text) == [((a, "<=", 0.5),), ((a, "<=", 0.25),), ((a, "<=", 0.5), (a, ">", 0.25)), ((a, ">", 0.5),)]


def test_quality_on_held_out_labels(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("score", F.lit(5)).withColumn("row", F.lit(1)).withColumn("symbols", F.lit(1))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stats = quality.with_statistics(docs)
    got = quality.scores(stats, quality.fit(stats, labels)).join(labels, "doc_id").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    held = got[got["held_out"]]
    assert len(held) > 50
    assert (held["predicted"] == held["quality"]).mean() > 0.95
    assert ((got["predicted"] == 1) == (got["score"] >= 0.3)).all()
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert 0.8 * docs.count() < kept.count() < docs.count()


def test_quality_of_nulls_and_without_labels(spark, documents):
    docs = documents([(1, None), (None, "a plain text"), (2, ""), (2, "x" * 50_000), (3, "\n\n\n")])
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    stats = quality.with_statistics(docs)
    rows = quality.scores(stats, quality.fit(stats, labels)).collect()
    assert len(rows) == 5
    assert {r["score"] for r in rows} == {0.5}
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True]
    one = spark.createDataFrame([(3, 1)], "doc_id long, quality int")
    assert {r["score"] for r in quality.scores(stats, quality.fit(stats, one)).collect()} == {1.0}
    assert quality.accepted(docs.where("false"), labels).count() == 0


def plain_nearest(rows, k):
    out = {}
    for q, v in rows:
        scored = sorted((-(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)).round(12), i) for i, w in rows if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_neighbours_of_a_small_table_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8)) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(12)]  # copies
    bad = [(200, None), (201, [0.0] * 8), (202, [1.0] * 7 + [None]), (203, [1.0] * 7 + [float("nan")]), (204, [1.0] * 7 + [float("inf")]), (None, [1.0] * 8), (205, [1.0] * 3)]
    table = [(i, [float(x) for x in v]) for i, v in rows] + bad
    vectors = spark.createDataFrame(table, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).withColumn("score", F.lit(1))
    got = neighbours.search(vectors, F.lit(True), k=5).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = plain_nearest(rows, 5)
    assert set(found) == set(want)
    for q, own in want.items():
        assert [i for i, _ in found[q]] == [i for i, _ in own]
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in own], abs=1e-9)


def test_neighbours_meet_in_split_leaves(spark, monkeypatch):
    """Many leaves in parts of rows and of queries; every leaf is asked for, so the result is exact. One vector is hot."""
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 20)
    monkeypatch.setattr(neighbours, "PART_ROWS", 7)
    monkeypatch.setattr(neighbours, "_budget", lambda *a: 10_000)
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(6)) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(2000 + i, rows[1][1] * 2.0**i) for i in range(9)]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in rows] + [(5, rows[5][1].tolist())], "vec_id long, embedding array<double>")
    found = {}
    for r in sorted(neighbours.search(vectors, F.lit(True)).collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["rank"]))
    want = plain_nearest(rows, 5)
    assert found == {q: [(i, n) for n, (i, _) in enumerate(own, 1)] for q, own in want.items()}


def test_neighbours_of_one_vec_id(spark):
    rng = np.random.default_rng(4)
    many = [(7, rng.standard_normal(4).tolist()) for _ in range(2000)]
    vectors = spark.createDataFrame([*many, (8, many[0][1]), (9, many[0][1])], "vec_id long, embedding array<double>")
    got = neighbours.search(vectors, F.col("vec_id") < 9).collect()
    assert {(r["rank"], r["vec_id"]) for r in got if r["query_id"] == 7} == {(1, 8), (2, 9)}
    own = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 8)
    assert own[:2] == [(1, 7), (2, 9)]
    assert [r for r, _ in own] == [1, 2, 3, 4, 5]


def test_a_forest_asks_for_few_leaves_where_vectors_have_structure(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 100)
    asked = []
    plain = neighbours._budget
    monkeypatch.setattr(neighbours, "_budget", lambda forest, *a: asked.append((plain(forest, *a), forest.leaves)) or asked[-1][0])
    rng = np.random.default_rng(5)
    centres = 4 * rng.standard_normal((40, 24))
    rows = [(i, (centres[i % 40] + rng.standard_normal(24)).tolist()) for i in range(6000)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = neighbours.search(vectors, F.col("vec_id") % 50 == 0).groupBy("query_id").agg(F.collect_set("vec_id")).collect()
    assert recall(rows, got) >= 0.9
    (budget, leaves), = asked
    assert leaves == 3 * 64
    assert budget / leaves < 0.1  # the share of the rows that a query is compared with is at most three times that


def recall(rows, got):
    table = np.array([v for _, v in rows], np.float32).astype(float)
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    hits = 0
    for q, found in got:
        near = table @ table[q]
        near[q] = -2
        hits += len(set(np.argsort(-near)[:5].tolist()) & set(found))
    return hits / (5 * len(got))


def test_neighbours_recall_and_few_or_no_rows(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 32))
    rows = [(i, (centres[i % 20] + 0.5 * rng.standard_normal(32)).tolist()) for i in range(3000)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.search(vectors, F.col("vec_id") % 50 == 0).groupBy("query_id").agg(F.collect_set("vec_id")).collect()
    assert len(got) == 60
    assert recall(rows, got) >= 0.9
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert sorted((r["query_id"], r["rank"]) for r in neighbours.search(few, F.col("vec_id") == 0).collect()) == [(0, 1), (0, 2)]
    assert neighbours.search(few.where("false"), F.lit(True)).count() == 0
    assert neighbours.search(few, F.lit(False)).count() == 0
