"""Nearest neighbours, WARC archives, the pipeline, and the registered queries."""

import hashlib
import itertools
import math

import numpy as np
import pytest
from conftest import SF0001
from llm_rows import DOC_SCHEMA, docs, empty, hard, prose  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from cityscan.llm import ann, catalog, warc
from cityscan.llm.common import connected_components, shared_path

VEC = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (8, 1)])
def test_hilbert_steps_to_a_neighbour(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    key = ann.hilbert(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    assert np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1).max() == 1


def brute_nearest(rows, is_query, k):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q, x in ok:
        if is_query(q):
            s = sorted((-sum(float(np.float32(a)) * float(np.float32(b)) for a, b in zip(x, v)), i) for i, v in ok if i != q)
            out += [(q, r + 1, i) for r, (_, i) in enumerate(s[:k])]
    return sorted(out)


def test_nearest_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(6) * (1 + i % 3)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]  # a vector many rows share
    odd = [(200, None), (201, [0.0] * 6), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("nan")] + [1.0] * 5),
           (204, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (205, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, VEC).withColumn("rank", F.lit(1)).withColumn("score", F.lit("x"))
    got = ann.nearest(df, lambda i: i % 20 == 0, k=20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == brute_nearest(rows, lambda i: i % 20 == 0, 20)
    few = ann.nearest(df.where("vec_id < 5 or vec_id = 20"), lambda i: i % 20 == 0, k=20).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in few) == sorted(
        (q, i) for q in (0, 20) for i in (0, 1, 2, 3, 4, 20) if i != q)
    assert ann.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall(spark, clusters):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 32))
    if clusters:
        x = 0.3 * x + rng.standard_normal((clusters, 32))[rng.integers(0, clusters, 4000)]
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], VEC)
    got = {}
    for r in ann.nearest(df, lambda i: i % 50 == 0, k=20, block_rows=200).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    s = x.astype(float) @ x.astype(float).T
    hit = 0
    for q in range(0, 4000, 50):
        s[q, q] = -np.inf
        hit += len(got[q] & set(np.argsort(-s[q], kind="stable")[:20].tolist()))
    assert hit / (80 * 20) >= 0.9


# ---------------------------------------------------------------- WARC


def pages_expected(rows, least=1000):
    data = [(i, (h or "").encode()) for i, h in rows]
    last = {}
    for i, b in data:
        if len(b) >= least:
            last[b] = max(last.get(b, i), i)
    out = []
    for i, b in data:
        again = len(b) >= least and last[b] != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", last[b] if again else None))
    return sorted(out)


def tricky_pages():
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    big = "é" * 600
    return [(0, "plain"), (1, None), (2, ""), (3, record), (4, "x" + record * 3 + "tail"), (5, "WARC/1.1\r\n" * 50),
            (6, big), (7, big), (8, big), (9, "y" * 999), (10, "y" * 999), (11, "\r\n\r\n"), (12, record[:-4]),
            (13, "z" * 1000), (14, "z" * 1000)] + [(20 + i, f"<p>{i}</p>" * 40 + record * (i % 3)) for i in range(60)]


@pytest.mark.parametrize("split", ["128m", "700"])
def test_archives_round_trip(spark, split):
    rows = tricky_pages()
    df = spark.createDataFrame([(i, f"http://x/{i}\r\nWARC/1.1\r\n", h) for i, h in rows], "page_id long, url string, html string")
    path = shared_path(spark, "test-warc")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        warc.write_archives(df.repartition(3), path)
        got = [(int(r["id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] and int(r["refers_to"]))
               for r in warc.read_archives(spark, path).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == pages_expected(rows)


def test_archives_empty_and_repeated(spark):
    schema = "page_id long, url string, html string, size string"
    path = shared_path(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([], schema), path)
    assert warc.read_archives(spark, path).count() == 0
    path = shared_path(spark, "test-warc")
    rows = [(1, None, "q" * 2000, "s"), (1, None, "q" * 2000, "s"), (None, "u", "q" * 2000, "s"), (2, "u", None, "s")]
    warc.write_archives(spark.createDataFrame(rows, schema), path)
    got = [(r["id"], r["payload_bytes"], r["record_type"]) for r in warc.read_archives(spark, path).collect()]
    assert sorted(got) == [("", 2000, "response"), ("1", 2000, "response"), ("1", 2000, "response"), ("2", 0, "response")]


def test_a_file_that_does_not_begin_with_a_record_has_none(spark):
    path = shared_path(spark, "test-warc")
    spark.createDataFrame([("junk WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n",)], "v string").coalesce(1).write.text(path)
    assert warc.read_archives(spark, path).count() == 0


# ---------------------------------------------------------------- components, pipeline, queries


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299), (299, 300)]
    got = {r["node"]: r["comp"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 299: 299, 300: 299}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    base = prose(2, 120)
    items = [" ".join(prose(700, 40))]
    rows = [(1, " ".join(base), "en", "a", 1), (2, " ".join(base[:119] + ["z"]), "en", "a", 1), (3, "### 12", "en", "a", 6),
            (4, " ".join(prose(9, 80)) + " " + items[0], "en", "b", 5), (5, " ".join(prose(10, 50)) + " password=hunter22", "en", "b", 7),
            (6, None, "en", "a", None), (None, " ".join(prose(11, 60)), None, None, 3)]
    d = spark.createDataFrame(rows, DOC_SCHEMA)
    spark.createDataFrame([(1, items[0])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    left = {"language_id": {1, 2, 4, 5, None}, "near_duplicates": {1, 4, 5, None}, "decontaminate": {1, 5, None}, "secrets": {1, 5, None}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, str(tmp_path))
        assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r["doc_id"] for r in d.collect()} == left[name], name
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} <= left["secrets"]
    assert all("hunter22" not in r["text"] and r["taken"] > 0 for r in out)
    five = [r for r in out if r["doc_id"] == 5]
    assert all(r["n_chars"] == len(r["text"]) and r["text"].endswith("[secret]") for r in five)


def test_queries_cover_the_whole_table(spark):
    n = {t: spark.read.parquet(f"{SF0001}/{t}.parquet").count() for t in ("documents", "pages")}
    for name in ("op5_ngram_join", "op6_substring_dedup"):
        assert catalog.QUERIES[name](spark, SF0001).count() == n["documents"]
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()]
    got = [tuple(r) for r in catalog.op9_warc(spark, SF0001).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got) == pages_expected(rows)
