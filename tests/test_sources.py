import json

import pytest

from pyspark.sql import functions as F

from cityscan.sources.csv import read_code_lines, read_delimited, read_incidents, union_periods, INCIDENT_SCHEMA
from cityscan.sources.geojson import features_to_zones, read_geojson


def test_csv_semicolon_and_money(spark, tmp_path):
    p = tmp_path / "income.csv"
    p.write_text('Zip Code;Community;Estimated Median Income\n90001;A;$52,806\n9a;B;N/A\n')
    df = read_delimited(spark, str(p), "`Zip Code` int, Community string, `Estimated Median Income` string", sep=";")
    rows = df.collect()
    assert rows[0]["Zip Code"] == 90001 and rows[1]["Zip Code"] is None


def test_csv_multiline_quoted_newline(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('a,b\n1,"x\ny"\n2,z\n')
    one = read_delimited(spark, str(p), "a int, b string", multiline=True).collect()
    assert [(r.a, r.b) for r in one] == [(1, "x\ny"), (2, "z")]
    lines = read_delimited(spark, str(p), "a int, b string", multiline=False).count()
    assert lines == 3  # line-based read splits the record (documented default)


def test_csv_too_few_and_many_fields_with_corrupt_column(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("a,b\n1\n2,x,extra\n3,y\n")
    rows = read_delimited(spark, str(p), "a int, b string", corrupt_column="_bad").collect()
    assert [r.a for r in rows] == [1, 2, 3]
    assert rows[0].b is None


def test_incidents_two_periods_union(spark, tmp_path):
    header = ",".join(f.name for f in INCIDENT_SCHEMA.fields)
    row = ["1", "", "2020 Jan 05 01:30:00 PM"] + [""] * 8 + ["30", "M", "H"] + [""] * 12 + ["34.0", "-118.2"]
    for name in ("p1.csv", "p2.csv"):
        (tmp_path / name).write_text(header + "\n" + ",".join(row) + "\n")
    a = read_incidents(spark, str(tmp_path / "p1.csv"))
    b = read_incidents(spark, str(tmp_path / "p2.csv"))
    u = union_periods([a, b])
    assert u.count() == 2 and u.select(F.sum("LAT")).first()[0] == 68.0
    assert read_incidents(spark, [str(tmp_path / "p1.csv"), str(tmp_path / "p2.csv")]).count() == 2


def test_code_lines(spark, tmp_path):
    p = tmp_path / "mo.txt"
    p.write_text("0100 Susp impersonate, other\n0101\n")
    full = {r.Mocode: r.Description for r in read_code_lines(spark, str(p)).collect()}
    assert full == {"0100": "Susp impersonate, other", "0101": None}
    cut = {r.Mocode: r.Description for r in read_code_lines(spark, str(p), truncate_at_comma=True).collect()}
    assert cut["0100"] == "Susp impersonate"


FEATURES = [
    {"type": "Feature", "properties": {"COMM": "A", "POP20": 10, "ZCTA20": "90001", "extra": 1},
     "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]],
                                                      [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]]}},
    {"type": "Feature", "properties": {"COMM": "B", "POP20": 0, "ZCTA20": "9a"},
     "geometry": {"type": "MultiPolygon", "coordinates": [[[[10, 10], [11, 10], [11, 11], [10, 10]]],
                                                           [[[20, 20], [21, 20], [21, 21], [20, 20]]]]}},
    {"type": "Feature", "properties": {"COMM": "C", "POP20": 5, "ZCTA20": None}, "geometry": None},
]
PROPS = {"COMM": "string", "POP20": "bigint", "ZCTA20": "string"}


def _check_zones(z):
    rows = {r.COMM: r for r in z.collect()}
    assert set(rows) == {"A", "B", "C"}
    assert rows["C"].edges is None and rows["C"].min_x is None and len({r.zone_id for r in rows.values()}) == 3
    assert len(rows["A"].edges) == 8 and len(rows["B"].edges) == 6
    assert (rows["B"].min_x, rows["B"].max_x) == (10.0, 21.0)


def test_geojson_feature_collection_pretty_printed(spark, tmp_path):
    p = tmp_path / "blocks.geojson"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=2))
    _check_zones(features_to_zones(read_geojson(spark, str(p), PROPS)))


def test_geojson_newline_delimited(spark, tmp_path):
    p = tmp_path / "blocks.ndjson"
    p.write_text("\n".join(json.dumps(f) for f in FEATURES) + "\n")
    _check_zones(features_to_zones(read_geojson(spark, str(p), PROPS, newline_delimited=True)))


def test_geojson_empty_collection(spark, tmp_path):
    p = tmp_path / "empty.geojson"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    assert features_to_zones(read_geojson(spark, str(p), PROPS)).count() == 0


def test_csv_binds_by_position_not_header_names(spark, tmp_path):
    p = tmp_path / "h.csv"
    p.write_text("Vict Descent,Something Else\nH,Hispanic\n")
    df = read_delimited(spark, str(p), "`Vict_Descent` string, `Vict_Descent_Full` string")
    assert [tuple(r) for r in df.collect()] == [("H", "Hispanic")]


def test_geojson_feature_lines_layout_is_splittable_and_checked(spark, tmp_path):
    p = tmp_path / "gdal.geojson"
    body = ",\n".join(json.dumps(f) for f in FEATURES)
    p.write_text('{\n"type": "FeatureCollection",\n"name": "blocks",\n"features": [\n' + body + "\n]\n}\n")
    _check_zones(features_to_zones(read_geojson(spark, str(p), PROPS, layout="feature_lines")))
    compact = tmp_path / "compact.geojson"
    compact.write_text(json.dumps({"type": "FeatureCollection", "features": FEATURES}))
    with pytest.raises(Exception, match="not one per line"):
        read_geojson(spark, str(compact), PROPS, layout="feature_lines").collect()


@pytest.mark.parametrize("layout,text", [
    ("sequence", json.dumps(FEATURES[0]) + "\n" + json.dumps(FEATURES[1])[:90] + "\n"),
    ("sequence", json.dumps({"type": "Point"}) + "\n"),
    ("document", json.dumps({"type": "FeatureCollection", "features": FEATURES})[:-120]),
    ("document", json.dumps({"type": "FeatureCollection"})),
    ("feature_lines", '{"features": [\n' + json.dumps(FEATURES[0])[:100] + ",\n" + json.dumps(FEATURES[1]) + "\n]}"),
])
def test_geojson_malformed_input_fails(spark, tmp_path, layout, text):
    p = tmp_path / "bad.geojson"
    p.write_text(text)
    with pytest.raises(Exception, match="malformed GeoJSON"):
        read_geojson(spark, str(p), PROPS, layout=layout).collect()


def test_geojson_malformed_coordinates_fail(spark, tmp_path):
    p = tmp_path / "bad.ndjson"
    p.write_text(json.dumps({"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": "x"}}) + "\n")
    with pytest.raises(Exception, match="malformed coordinates"):
        features_to_zones(read_geojson(spark, str(p), PROPS, layout="sequence")).collect()


def test_incident_corrupt_column_counts_bad_rows(spark, tmp_path):
    from cityscan.sources.csv import corrupt_rows

    names = [f.name for f in INCIDENT_SCHEMA.fields]
    good, bad = [""] * len(names), [""] * len(names)
    good[names.index("Vict Age")], bad[names.index("Vict Age")] = "30", "abc"
    p = tmp_path / "i.csv"
    p.write_text("\n".join(",".join(x) for x in (names, good, bad)) + "\n")
    df = read_incidents(spark, str(p), corrupt_column="_bad")
    assert tuple(corrupt_rows(df, "_bad").first()) == (2, 1)
    assert [r["Vict Age"] for r in df.where("_bad is not null").collect()] == [None]
