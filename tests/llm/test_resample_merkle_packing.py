"""Importance resampling, Merkle manifest and packing against brute force, also on hard rows."""

import hashlib
import math
import os
import re
import shutil
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF0001
from hypothesis import example, given, settings
from hypothesis import strategies as st
from llm_rows import DOC_SCHEMA, docs, empty, hard, prose  # noqa: F401
from pyspark.sql import functions as F

from cityscan.llm import catalog, merkle, packing, resample
from cityscan.llm.common import in_order, shared_table

# ---------------------------------------------------------------- order


def test_places_in_order_by_group(spark):
    rows = [(i * 37 % 101 % 20, i % 3 if i % 3 else None, i) for i in range(300)]
    out = in_order(spark.createDataFrame(rows, "k int, g int, i int").repartition(7), [F.desc("k"), F.col("i")], "t", ["g"]).collect()
    groups = defaultdict(list)
    for r in out:
        groups[r["g"]].append(r)
    assert len(out) == 300 and len(groups) == 3
    for g in groups.values():
        g.sort(key=lambda r: r["place"])
        assert [r["place"] for r in g] == list(range(len(g)))
        assert [(r["k"], r["i"]) for r in g] == sorted(((r["k"], r["i"]) for r in g), key=lambda x: (-x[0], x[1]))


def test_equal_rows_have_places_of_their_own(spark):
    out = in_order(spark.createDataFrame([(1,)] * 50, "k int").repartition(5), [F.col("k")], "t").collect()
    assert sorted(r["place"] for r in out) == list(range(50))


# ---------------------------------------------------------------- importance resampling


def resampled(rows, target, percent, least, buckets, runs):
    """``rows`` (id, text) to (id, n_features, weight, score, rank), one by one."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(low))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, runs + 1) for i in range(len(w) - k + 1)]

    raw, aim = Counter(), Counter()
    for _, t in rows:
        raw.update(features(t)[1])
    for t in target:
        aim.update(features(t)[1])
    s, t = sum(raw.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in raw}
    out = []
    for i, text in rows:
        n, f = features(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, text, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in out if r[2] >= least), key=lambda r: (-r[5], r[0] is None, r[0]))
    k = len(able) * percent // 100
    rank = {id(r): j + 1 for j, r in enumerate(able[:k])}
    return [(r[0], r[3], r[4], r[5], rank.get(id(r))) for r in out]


@pytest.mark.parametrize("runs, percent", [(1, 10), (2, 35)])
def test_resample_equals_brute_force(spark, docs, runs, percent):  # noqa: F811
    rows = [(i, " ".join(prose(i, 5 + i % 40, 60))) for i in range(120)] + [(200, None), (201, ""), (202, "ÀB É ünd 9x_Y\x1cz " * 9)]
    target = [" ".join(prose(900 + i, 30, 25)) for i in range(9)] + [None]
    out = resample.resample(docs(rows), spark.createDataFrame([(t,) for t in target], "text string"), percent=percent, buckets=500, runs=runs)
    got = [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in out.collect()]
    assert sorted(got) == sorted(resampled(rows, target, percent, 20, 500, runs))
    assert sum(g[4] is not None for g in got) == (sum(5 + i % 40 >= 20 for i in range(120)) + 1) * percent // 100


def test_resample_ties_repeated_rows_nulls(spark, docs):  # noqa: F811
    text = " ".join(prose(3, 30))
    rows = [(7, text)] * 40 + [(7, text + " more")] * 3 + [(None, text)] * 20 + [(i, text) for i in range(30)]
    out = resample.resample(docs(rows).repartition(6), spark.createDataFrame([(text,)], "text string"), percent=50)
    got = out.collect()
    assert len(got) == len(rows) and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(rows) // 2 + 1))
    best = sorted(got, key=lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"]))
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [(r["score"], r["doc_id"]) for r in drawn] == [(r["score"], r["doc_id"]) for r in best[:len(drawn)]]


def test_resample_hard_rows(spark, hard, empty):  # noqa: F811
    out = resample.resample(hard, hard)
    assert set(out.columns) == (set(hard.columns) - {"text"}) | {"n_words", "n_features", "weight", "score", "rank"}
    rows = out.collect()
    assert len(rows) == hard.count() and [r["n_features"] for r in rows if r["doc_id"] in (3, 4, 5)] == [0, 0, 0]
    assert resample.resample(empty, hard).collect() == []
    assert {r["rank"] for r in resample.resample(hard.where("doc_id = 6"), empty, percent=100).collect()} == {1}
    with pytest.raises(TypeError):
        resample.resample(hard.withColumn("doc_id", F.lit("x")), hard)


def test_draw_finds_every_size(spark):
    rows = [(i * 7 % 13 - 6, i) for i in range(60)]
    t = shared_table(spark.createDataFrame(rows, "a long, b long"), "draw")
    order = sorted(rows)
    for k in (0, 1, 7, 33, 59, 60):
        assert sorted(map(tuple, t.where(resample.draw(t, k, ["a", "b"])).collect())) == order[:k]


# ---------------------------------------------------------------- Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """The levels of a binary tree of ``leaves``."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([h(*x[i:i + 2]) for i in range(0, len(x), 2)])
    return levels


def path_of(levels, i):
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append((j < i, level[j] if j < len(level) else None))
        i >>= 1
    return out


def manifested(rows):
    """``rows`` (doc_id, text, lang, source, n_chars) to the columns of op12."""
    enc = lambda *v: "".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in v)
    groups = defaultdict(list)
    for d, text, lang, source, n in rows:
        leaf = h(enc(d, source, lang, n, text))
        bad = d is not None and zlib.crc32(str(d).encode()) % 7 == 0
        seen = h(enc(d, source, lang, n + 1, text)) if bad and n is not None else leaf
        groups[lang].append((d is not None, d or 0, leaf, seen, d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: r[:3])
        trees[g] = tree([r[2] for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for gi, g in enumerate(names):
        for i, (_, _, leaf, seen, d) in enumerate(groups[g]):
            path = path_of(trees[g], i) + path_of(top, gi)
            x = seen
            for left, other in path:
                x = h(other or "", x) if left else h(x, other or "")
            out.append((d, leaf, trees[g][-1][0], top[-1][0], h(*[o for _, o in path if o]), x, x == top[-1][0]))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def op12(df):
    return merkle.manifest(df, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"n_chars": F.col("n_chars") + 1},
                           F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0).select(COLUMNS)


@pytest.mark.parametrize("n", [1, 2, 3, 255, 257, 1100])
def test_manifest_equals_brute_force(spark, n):
    rows = [(i * 3, f"text {i}", "en" if i % 9 else None, "s", i if i % 5 else None) for i in range(n)]
    got = [tuple(r) for r in op12(spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)).collect()]
    assert sorted(got) == sorted(manifested(rows))
    assert n < 300 or {r[-1] for r in got} == {True, False}


def test_manifest_of_three_levels_and_many_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_HEIGHT", 2)
    rows = [(i, "x" * (i % 7), f"l{i % 21}" if i > 90 else "en", "s", i) for i in range(170)]
    got = [tuple(r) for r in op12(spark.createDataFrame(rows, DOC_SCHEMA)).collect()]
    assert sorted(got) == sorted(manifested(rows))


def test_manifest_hard_rows(hard, empty):  # noqa: F811
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in hard.collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in op12(hard).collect()), key=key) == sorted(manifested(rows), key=key)
    assert op12(empty).collect() == []


@pytest.mark.parametrize("height", range(1, 12))
def test_addresses_fill_the_block_and_keep_subtrees_together(height):
    places = [merkle.address(np.full(1 << d, d), np.arange(1 << d), height) for d in range(height)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << height) - 1))
    assert places[0][0] == 0
    if height > 1:
        top = height // 2
        assert sorted(np.concatenate(places[:top]).tolist()) == list(range((1 << top) - 1))
        for t in range(1 << top):  # each lower tree lies in one run
            nodes = np.concatenate([places[d][t << (d - top):(t + 1) << (d - top)] for d in range(top, height)])
            assert nodes.max() - nodes.min() + 1 == len(nodes)


# ---------------------------------------------------------------- packing


def served_in_turn(queues, window, run):
    """Deficit round-robin one round after the other: the stream as (queue, token) in order."""
    total = sum(queues)
    deficit, at, out = [0] * len(queues), [0] * len(queues), []  # deficits in 1 / total tokens
    rounds = -(-total // window)
    for k in range(rounds):
        for q, size in enumerate(queues):
            deficit[q] += window * size
            n = min(size - at[q], deficit[q] // (total * run) * run) if k + 1 < rounds else size - at[q]
            out += [(q, at[q] + i) for i in range(n)]
            at[q] += n
            deficit[q] -= n * total
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=7), st.sampled_from([16, 32, 64]), st.sampled_from([1, 3, 16]))
def test_rounds_equal_serving_in_turn(queues, window, run):
    stream = served_in_turn(queues, window, run)
    place = {x: i for i, x in enumerate(stream)}
    rounds = packing.Rounds(queues, window, run)
    whole = sum(queues) // window
    for q, size in enumerate(queues):
        for first in range(0, size, 29):
            n, at = min(29, size - first), 0
            for start, length, sequence, offset in rounds.pieces(q, first, n):
                assert start == at and length > 0
                for i in range(length):
                    p = place[(q, first + start + i)]
                    if p < whole * window:
                        assert (sequence, offset + i) == (p // window, p % window)
                    else:
                        assert sequence >= whole
                at += length
            assert at == n


def check_packing(rows, pieces, window):
    """Each id in one piece, gapless sequences, none but the last ones short, and those powers of two."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    want = Counter()
    for i, text, source in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want[(i, source, tuple(ids))] += 1
    docs_, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        docs_[(p["doc_id"], p["source"], p["doc_tokens"])].append((p["start"], np.frombuffer(p["ids"], "<u4").tolist()))
    got = Counter()
    for (i, source, n), parts in docs_.items():
        parts.sort(key=lambda x: x[0])
        open_ = []  # documents that repeat an id and a length are put together again piece by piece
        for start, ids in parts:
            for o in open_:
                if len(o) == start:
                    o += ids
                    break
            else:
                assert start == 0
                open_.append(list(ids))
        for o in open_:
            assert len(o) == n
            got[(i, source, tuple(o))] += 1
    assert got == want
    sizes = {}
    for s, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes[s] = at
    assert sorted(sizes) == list(range(len(sizes)))
    total = sum(sizes.values())
    assert [sizes[s] for s in range(total // window)] == [window] * (total // window)
    rest = [sizes[s] for s in range(total // window, len(sizes))]
    assert all(x & (x - 1) == 0 for x in rest) and rest == sorted(set(rest), reverse=True)
    return sizes


def test_packing_whole_and_in_proportion(spark):
    rows = [(i, " ".join(prose(i, 1 + i * 13 % 90)), ["big", "mid", "small", None][0 if i % 3 == 0 else 1 + i % 3]) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = packing.pack(df, window=256, least_run=8).collect()
    check_packing(rows, out, 256)
    tokens = Counter()
    for p in out:
        tokens[p["source"]] += p["length"]
    total = sum(tokens.values())
    by_sequence = defaultdict(Counter)
    for p in out:
        by_sequence[p["sequence_id"]][p["source"]] += p["length"]
    for s in range(total // 256 - 1):
        for source, n in tokens.items():
            assert abs(by_sequence[s][source] - 256 * n / total) <= 2 * 8 + 2, (s, source)


def test_packing_more_sources_than_queues(spark):
    rows = [(i, " ".join(prose(i, 20)), f"s{i % 17}") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    check_packing(rows, packing.pack(df, window=128, queues=4).collect(), 128)
    check_packing(rows, packing.pack(df, window=128, queues=1).collect(), 128)


def test_packing_hard_rows(spark, hard, empty):  # noqa: F811
    rows = [(r["doc_id"], r["text"], r["source"]) for r in hard.collect()]
    out = packing.pack(hard)
    pieces = out.collect()
    sizes = check_packing(rows, pieces, 2048)
    assert packing.pack(empty).collect() == []
    assembled = {r["sequence_id"]: (r["n_tokens"], len(r["ids"]) // 4) for r in packing.assemble(out).collect()}
    assert assembled == {s: (n, n) for s, n in sizes.items()}


def test_packing_query(spark):
    d = spark.read.parquet(f"{SF0001}/documents.parquet")
    out = catalog.op13_packing(spark, SF0001).collect()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in d.collect()]
    full = packing.pack(d).collect()
    check_packing(rows, full, 2048)
    key = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")
    assert sorted((*[p[k] for k in key], zlib.crc32(p["ids"])) for p in full) == sorted((*[p[k] for k in key], p["ids_crc32"]) for p in out)


TEXTS = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\r\x0b\x0c'<|>s.,a!Ie\u0301\u0307\u0338=\u03a3\u03c3\x1c\x85\xa0 \u0130A9")), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_ids_of_chunks_are_the_ids_of_the_text(texts):
    known = VOCABULARY.setdefault("v", packing.Vocabulary(packing.default_vocabulary()) if not VOCABULARY else None)
    known.limit = 20  # chunks are forgotten and learned again
    got = [np.frombuffer(x, known.kind).tolist() for x in known.encode([t.encode() for t in texts])]
    assert got == [known.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_tokens_and_null_texts():
    known = packing.Vocabulary(packing.default_vocabulary())
    text = "a<|endoftext|>b <|startoftext|> x"
    assert known.encode([None, b"", text.encode()])[:2] == [b"", b""]
    assert np.frombuffer(known.encode([text.encode()])[0], known.kind).tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from("a\u0130\u0131\u00e9\u00c9\u017f\u00df\u03c3\u03a39\u0301'"), max_size=3), st.text(st.sampled_from(",.!=<'"), max_size=2)), max_size=8))
@example([("\u0130", ",")])
def test_marks_after_any_letter_are_encoded_as_in_the_text(chunks):
    known = VOCABULARY.setdefault("v", packing.Vocabulary(packing.default_vocabulary()) if not VOCABULARY else None)
    text = " ".join(core + marks for core, marks in chunks)
    assert np.frombuffer(known.encode([text.encode()])[0], known.kind).tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_encoded_once_and_apart_from_their_marks():
    known, seen = packing.Vocabulary(packing.default_vocabulary()), []
    of_words = known._of_words
    known._of_words = lambda words: seen.extend(words) or of_words(words)
    for text in b"reshon theble, reshon.", b"theble!! (reshon) Theble ofrere", b"ofrere, of":
        assert np.frombuffer(known.encode([text])[0], known.kind).tolist() == known.tokenizer.encode(text.decode(), add_special_tokens=False).ids
    assert sorted(seen) == ["of", "ofrere", "reshon", "theble"]


def test_words_told_apart_without_marked_last_ids():
    known = packing.Vocabulary(packing.default_vocabulary())
    known.last[:] = False
    text = "reshon theble d\u00e9o, reshon."
    assert np.frombuffer(known.encode([text.encode()])[0], known.kind).tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_vocabulary_is_kept_until_its_file_changes(tmp_path):
    path = shutil.copy(packing.default_vocabulary(), str(tmp_path / "v.json"))
    first = packing.vocabulary_of(path)
    first.encode([b"reshon"])
    assert packing.vocabulary_of(path) is first and "reshon" in packing.vocabulary_of(path).young
    os.utime(path, ns=(1, 1))
    assert packing.vocabulary_of(path) is not first


VOCABULARY = {}
