"""Language profiles and source mixing."""

import math

import numpy as np
import pytest
from conftest import SF0001
from pyspark.sql import functions as F

from llm_rows import docs, empty, hard  # noqa: F401

from cityscan.llm import catalog, langid, mixing


def brute_rank(text, top):
    t = "".join(c if c.isalpha() else " " for c in text.lower())
    t = " " + " ".join(t.split()) + " "
    n = {}
    for k in (1, 2, 3):
        for i in range(len(t) - k + 1):
            g = t[i:i + k]
            if g != " ":
                n[g] = n.get(g, 0) + 1
    return [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:top]]


def grams_text(keys):
    out = []
    for key in keys:
        s = ""
        while key:
            s, key = chr(key & 0x1FFFFF) + s, key >> 21
        out.append(s)
    return out


def test_rank_order_equals_brute_force():
    letters = langid._letter_table()
    for text in ("The cat, the hat; THE END.", "éÉ ß x", "a"):
        got = grams_text(langid.ranked(langid.gram_keys(langid.letter_codes(text, letters)), 300))
        assert got == brute_rank(text, 300)


def test_out_of_place_distance():
    p = langid.Profiles({"a": [1, 2, 3], "b": [3, 2, 1]}, top=10)
    # 9 is unknown: 10; under a: |0-0| + |1-2| + 10
    lang, score = p.nearest(np.array([1, 3, 9]))
    assert lang == "a" and score == pytest.approx(1 - 11 / 30)


def test_held_out_accuracy(spark):
    rows = catalog.op8_language_id(spark, SF0001).collect()
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(true) and held
    assert sum(r["lang_pred"] == true[r["doc_id"]] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_langid_hard_rows(hard, empty):
    profiles = langid.learn_profiles(hard)
    out = langid.identify(hard, profiles)
    rows = out.collect()
    assert out.columns.count("score") == 1 and len(rows) == hard.count()
    for r in rows:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] != "und") == letters
    assert langid.learn_profiles(empty) == {}
    assert [r["lang_pred"] for r in langid.identify(hard.limit(2), {}).collect()] == ["und", "und"]
    assert langid.identify(empty, profiles).count() == 0


def level(sizes):
    """Targets by the rule itself: share, stop at three times, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > 3 * sizes[s]]
        if not over:
            target |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            open_.remove(s)
        left -= sum(target[s] for s in over)
    return target


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, None: 3, "c": 50}, {"z": 5}, {"a": 0, "b": 7, "c": 0},
                                   {"a": 10, "b": 10, "c": 10, "d": 4000}])
def test_targets_by_the_rule(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    for s, t in level(sizes).items():
        assert got[s] == pytest.approx(t)


def test_mix_takes_the_smallest_keys(spark):
    rows = [r for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text", "source").collect()]
    got = catalog.op3_mix_sources(spark, SF0001).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault((r["source_size"], r["target"]), []).append(r)
    for (size, target), part in by.items():
        if size:
            assert abs(sum(r["taken"] for r in part) - target) <= 1
        assert all(r["taken"] <= 3 * r["size"] for r in part)
    # complete epochs first, then whole documents in order of key, one of them cut
    keys = {r["doc_id"]: r["k"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").select(
        "doc_id", mixing.sample_key(F.col("doc_id"), mixing.quality_weight(
            F.col("text"), F.size(mixing.split_words(F.col("text"))))).alias("k")).collect()}
    for (size, target), part in by.items():
        epochs, room = math.floor(target / size), math.floor(target - math.floor(target / size) * size)
        for r in sorted(part, key=lambda r: keys[r["doc_id"]]):
            take = max(0, min(r["size"], room))
            assert r["taken"] == epochs * r["size"] + take
            room -= take


def test_mix_hard_rows(hard, empty):
    a, b = mixing.mix(hard), mixing.mix(hard)
    assert a.count() == hard.count() and a.columns.count("size") == 1
    key = lambda df: sorted(map(str, df.select("doc_id", "source", "size", "taken").collect()))
    assert key(a) == key(b)
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(hard.where("text is null")).select("size", "taken").collect() == [(0, 0)]
