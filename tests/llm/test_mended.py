"""Ties in the search, rare labels, hot ids in the mix, boilerplate in the n-gram join, and the whole pipeline."""

import duckdb
import numpy as np
import pyarrow as pa
from conftest import SF0001
from llm_rows import DOC_SCHEMA, docs, empty, hard, prose  # noqa: F401
from test_text_operators import brute_components, five, runs_as_long

import corpus_pipeline
from cityscan.llm import ann, langid, mixing, ngram_join, quality, secret_scan, toxicity
from cityscan.llm.common import scratch_tables, shared_table

# ---------------------------------------------------------------- search


def test_best_takes_the_first_of_equal_scores():
    rng = np.random.default_rng(4)
    scores = rng.integers(0, 4, (50, 200)).astype(float)
    got = ann._best(scores, 21)
    for row, at in zip(scores, got):
        assert sorted(at) == sorted(np.lexsort((np.arange(200), -row))[:21])
    assert sorted(ann._best(np.ones((1, 90)), 5)[0]) == [0, 1, 2, 3, 4]


def test_ties_go_to_smaller_ids(spark):
    """Many different vectors of the same score for the query."""
    rng = np.random.default_rng(5)
    rest = rng.standard_normal((900, 7)).astype(np.float32)
    rows = [(20, [1.0] + [0.0] * 7)] + [(1000 + i, [1.0, *map(float, v)]) for i, v in enumerate(rest)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)
    got = ann.nearest(df, lambda i: i == 20, k=20).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1000, 1020))
    assert {r["score"] for r in got} == {1.0}


def test_groups_of_queries_give_the_same_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((700, 12)).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = sorted(map(tuple, ann.nearest(df, lambda i: i % 2 == 0, k=5, block_rows=100).collect()))
    monkeypatch.setattr(ann, "_ASKED", 9)
    assert sorted(map(tuple, ann.nearest(df, lambda i: i % 2 == 0, k=5, block_rows=100).collect())) == whole


# ---------------------------------------------------------------- classifiers


def test_a_rare_label_is_learned(spark):
    """One row in 10,000 is toxic; a sample without regard to labels would hold none or one of them."""
    d = spark.range(60_000).selectExpr("id as doc_id", "concat('plain', id % 3, ' word', id % 7, if(id % 10000 = 7, ' vile', '')) as text")
    labels = d.selectExpr("doc_id", "cast(doc_id % 10000 = 7 as int) as toxic")
    model = toxicity.train(d, labels, max_rows=2_000)
    probe = spark.createDataFrame([(1, "plain1 vile word4"), (2, "plain1 word4"), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(probe, model).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_a_rare_grade_is_learned(spark):
    d = spark.range(30_000).selectExpr("id as doc_id", "concat('plain', id % 37, if(id % 5000 = 7, ' awful awful', ' fine')) as text")
    model = quality.train(d, d.selectExpr("doc_id", "if(doc_id % 5000 = 7, 0, 1) as grade"), max_rows=1_000)
    assert model.grades == [0, 1]
    probe = spark.createDataFrame([(1, "plain3 awful awful"), (2, "plain3 fine")], "doc_id long, text string")
    tail = {r["doc_id"]: r["tail_prob"] for r in quality.rate(probe, model, 1).collect()}
    assert tail[1] < 0.5 and tail[2] > 0.9


def test_shares_fill_the_bound():
    assert toxicity.swaps({"women"})[0] == set()
    assert quality._shares({0: 10, 1: 10_000, 2: 90_000}, 8_000) == {0: 1.0, 1: 3995 / 10_000, 2: 3995 / 90_000}
    assert quality._shares({0: 3, 1: 4}, 8_000) == {0: 1.0, 1: 1.0}


def test_swaps_reach_the_fit_as_differences():
    used = frozenset(i for w in ("women", "men", "vile") for i in toxicity.word_features(w))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["vile women " + " ".join(prose(1, 500))])], ["y", "text"])
    row = next(toxicity._sample_rows(used, (("women", "men"),))(iter([batch]))).to_pylist()[0]
    gone, came = (set(toxicity.word_features(w)) for w in ("women", "men"))
    assert [sorted(c) for c in row["changes"]] == [sorted(-1 - i for i in gone), sorted([-1 - i for i in gone - came] + list(came - gone))]


# ---------------------------------------------------------------- mix


def test_a_third_of_all_rows_under_one_id(spark):
    """The rows of one id share a key; they are cut in order of their texts, and add up to the target."""
    rows = [(7, " ".join(prose(i, 5 + i % 9)), "en", "a", 1) for i in range(60)] + [(1000 + i, " ".join(prose(i, 8)), "en", "ab"[i % 2], 1) for i in range(120)]
    rows += [(None, "x y z", "en", "b", 1)] * 30
    out = mixing.mix(spark.createDataFrame(rows, DOC_SCHEMA).repartition(5)).collect()
    assert len(out) == len(rows)
    for source in "ab":
        mine = [r for r in out if r["source"] == source]
        assert sum(r["taken"] for r in mine) == int(mine[0]["target"])
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in mine)
    again = mixing.mix(spark.createDataFrame(rows[::-1], DOC_SCHEMA).repartition(3)).collect()
    key = lambda r: (str(r["doc_id"]), r["text"], r["source"], r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, again))


# ---------------------------------------------------------------- n-gram join


def boilerplate(n):
    """Texts of 10 paragraphs out of 30: all share many n-grams, none are similar."""
    paragraphs = [" ".join(prose(5000 + i, 40)) for i in range(30)]
    rng = np.random.default_rng(8)
    return [(i, " ".join(paragraphs[j] for j in rng.permutation(30)[:10]) + " " + " ".join(prose(9000 + i, 6))) for i in range(n)]


def test_boilerplate_is_asked_for_by_block_not_by_pair(spark, docs, monkeypatch):
    asked = []
    entries = ngram_join._entries_of
    monkeypatch.setattr(ngram_join, "_entries_of", lambda a, *rest: (asked.append(a.count()), entries(a, *rest))[1])
    sizes = []
    for n in (120, 240):
        asked.clear()
        out = ngram_join.similar_components(docs(boilerplate(n))).collect()
        assert all(r["component_id"] == r["doc_id"] for r in out)
        sizes.append(sum(asked))
    assert sizes[1] <= 2.5 * max(sizes[0], 120)  # rows sent to blocks, not the pairs that meet there


def test_a_forest_connects_what_the_links_connect():
    rng = np.random.default_rng(3)
    for n in (1, 5, 60):
        p, q = rng.integers(0, 40, n), rng.integers(40, 80, n)
        a, b = ngram_join._forest(p, q)

        def parts(x, y):
            of = {v: {v} for v in {*p.tolist(), *q.tolist()}}
            for u, v in zip(x.tolist(), y.tolist()):
                whole = of[u] | of[v]
                for w in whole:
                    of[w] = whole
            return {frozenset(v) for v in of.values()}

        assert parts(a, b) == parts(p, q) and len(a) == len(set(p.tolist()) | set(q.tolist())) - len(parts(p, q))
    assert len(ngram_join._forest(np.zeros(0, np.int64), np.zeros(0, np.int64))[0]) == 0


# ---------------------------------------------------------------- pipeline


def test_stages_keep_columns_named_like_the_operators_own(hard, empty, spark, tmp_path):
    spark.createDataFrame([(1, "no such words in any text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, hard, str(tmp_path))
        assert out.columns == hard.columns, name
        assert {v for r in out.collect() for c, v in r.asDict().items() if c in ("score", "size", "spans", "rank", "node", "key")} == {"own"}
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_scratch_tables_go(spark):
    with scratch_tables():
        gone = shared_table(spark.range(3), "gone")
        kept = shared_table(gone.where("id > 0"), "kept", kept=True)
    fs = spark._jvm.org.apache.hadoop.fs.Path(gone.table_path).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(gone.table_path)) and kept.count() == 2


def test_pipeline_equals_its_stages_one_by_one(spark):
    """run() against plain Python (near copies, benchmark items, secrets) and DuckDB (the mix); languages by the operator alone."""
    d = spark.read.parquet(f"{SF0001}/documents.parquet")
    named = langid.identify(d.select("doc_id", "text"), langid.learn_profiles(d)).collect()
    fine = {r["doc_id"] for r in named if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
    rows = {r["doc_id"]: r for r in d.collect() if r["doc_id"] in fine}
    comp = {i: c for i, _, c in brute_components([(i, r["text"]) for i, r in rows.items()], 5, 80)}
    rows = {i: r for i, r in rows.items() if comp[i] == i}
    items = [five(r["text"]) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    rows = {i: r for i, r in rows.items()
            if not any(u and 100 * len(runs_as_long(r["text"], u) & u) >= 80 * len(u) for u in items)}
    kept = spark.createDataFrame(list(rows.values()), d.schema)
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scan(kept.select("doc_id", "text")).collect()}
    clean = []
    for i, r in rows.items():
        text, cuts = r["text"], []
        for s in sorted(spans[i], key=lambda s: (s["start"], s["end"])):
            if cuts and s["start"] < cuts[-1][1]:
                cuts[-1][1] = max(cuts[-1][1], s["end"])
            else:
                cuts.append([s["start"], s["end"]])
        for a, b in reversed(cuts):
            text = text[:a] + "[secret]" + text[b:]
        clean.append({"doc_id": i, "source": r["source"], "text": text})
    documents = pa.Table.from_pylist(clean)  # read by name in the SQL below
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.sql(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE_SQL}) t WHERE taken > 0").fetchall()
    out = corpus_pipeline.run(spark, SF0001).collect()
    texts = {r["doc_id"]: r["text"] for r in clean}
    assert sorted((r["doc_id"], r["size"], r["taken"]) for r in out) == sorted(want) and len(want) > 50
    assert all(r["text"] == texts[r["doc_id"]] for r in out)
