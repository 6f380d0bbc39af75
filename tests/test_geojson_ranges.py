"""GeoJSON documents read by byte ranges give what a whole parse gives."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cityscan.sources.geojson import features_to_zones, read_geojson

PROPS = {"zone": "bigint", "name": "string"}
NASTY = ['plain', 'br}ace{s', 'q"uote', 'back\\slash', '\\"}', 'é }', '],"features":[', '{"type":"Feature"}', '\\\\', '']


def _feature(i, rnd):
    x, y, n = rnd.random(), rnd.random(), rnd.randint(3, 40)
    ring = [[x + j, y - j * 2] for j in range(n)]
    geometry = rnd.choice([None, {"type": "Polygon", "coordinates": [ring + ring[:1]]}, {"type": "MultiPolygon", "coordinates": [[ring + ring[:1]]]}])
    return {"type": "Feature", "properties": {"zone": i, "name": rnd.choice(NASTY), "more": {"deep": [{"a": [1, {"b": "}"}]}]}}, "geometry": geometry}


def _document(n, seed):
    rnd = random.Random(seed)
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": 'x } " {'}}, "others": [{"type": "Feature", "zone": -1}],
            "features": [_feature(i, rnd) for i in range(n)], "after": [{"features": [{"type": "Feature"}]}], "end": "features"}


@pytest.fixture
def small_ranges(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def _rows(df):
    return sorted(map(str, features_to_zones(df, id_col="zone").collect()))


@pytest.mark.parametrize("size", [150, 1000, 7000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 1])
def test_ranges_equal_the_whole_parse(spark, tmp_path, small_ranges, size, indent):
    (tmp_path / "a.json").write_text(json.dumps(_document(60, 1), indent=indent), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps(_document(3, 2), indent=indent, ensure_ascii=False) + " \n ", encoding="utf-8")
    (tmp_path / "c.json").write_text('{"type":"FeatureCollection","features":[]}', encoding="utf-8")
    small_ranges(size)
    got = read_geojson(spark, str(tmp_path), PROPS, layout="ranges")
    if size == 1000:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
    assert _rows(got) == _rows(read_geojson(spark, str(tmp_path), PROPS, layout="document"))
    assert got.count() == 63


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(names=st.lists(st.text(st.sampled_from('{}[]"\\:, aé'), max_size=12), max_size=25), size=st.integers(40, 400))
def test_any_text_in_strings(spark, tmp_path_factory, small_ranges, names, size):
    path = tmp_path_factory.mktemp("doc") / "d.json"
    feats = [{"type": "Feature", "properties": {"zone": i, "name": n}, "geometry": None} for i, n in enumerate(names)]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": feats}, ensure_ascii=False), encoding="utf-8")
    small_ranges(size)
    got = read_geojson(spark, str(path), PROPS, layout="ranges").select("properties.zone", "properties.name").collect()
    assert sorted(map(tuple, got)) == list(enumerate(names))


@pytest.mark.parametrize("text", [
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"zone":1},"geometry":null}',
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"zone":1},"geometry":null}]',
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"zone":1},"geometry":null}]}}',
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"zone":1,"name":"x},"geometry":null}]}',
    '{"type":"FeatureCollection","other":[{"type":"Feature"}]}',
    '{"type":"FeatureCollection","features":[{"type":"Point"}]}',
])
def test_malformed_documents_fail(spark, tmp_path, small_ranges, text):
    (tmp_path / "x.json").write_text(text)
    small_ranges(40)
    with pytest.raises(Exception, match="malformed"):
        read_geojson(spark, str(tmp_path), PROPS, layout="ranges").collect()
