"""The five analyses end to end on small files in the original layouts."""

import csv
import json
import math

import pytest

from cityscan.plans import incident_reports as R
from cityscan.sources.csv import INCIDENT_SCHEMA

CRIMES = [
    # DR_NO, DATE OCC, Crm Cd Desc, Mocodes, Vict Age, Vict Descent, LAT, LON
    ("1", "2020 Jan 05 01:30:00 PM", "AGGRAVATED ASSAULT", "0100 0200", "30", "H", "34.05", "-118.25"),
    ("2", "2020 Feb 05 01:30:00 PM", "ASSAULT WITH DEADLY WEAPON, AGGRAVATED ASSAULT", "0100", "17", "W",
     "34.06", "-118.26"),
    ("3", "2021 Mar 05 01:30:00 AM", "THEFT", "0200  0300 ", "70", "H", "34.2", "-118.4"),
    ("4", "2021 Mar 06 01:30:00 AM", "AGGRAVATED ASSAULT", "", "", "B", "0", "0"),
    ("5", "2019 Mar 06 01:30:00 AM", "BURGLARY", "0300", "22", "X", "34.05", "-118.25"),
    ("6", "2020 Jul 01 11:00:00 PM", "AGGRAVATED ASSAULT", "0100", "20", "H", "34.21", "-118.41"),
]


def _square(x0, y0, x1, y1):
    return [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("ref")
    names = [f.name for f in INCIDENT_SCHEMA.fields]
    for part, rows in (("p1.csv", CRIMES[:3]), ("p2.csv", CRIMES[3:])):
        with open(d / part, "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(names)
            for dr, date, desc, mo, age, descent, lat, lon in rows:
                rec = dict.fromkeys(names, "")
                rec.update({"DR_NO": dr, "DATE OCC": date, "Crm Cd Desc": desc, "Mocodes": mo, "Vict Age": age,
                            "Vict Descent": descent, "LAT": lat, "LON": lon})
                w.writerow([rec[n] for n in names])
    (d / "re.csv").write_text("Vict Descent,Vict Descent Full\nH,Hispanic\nW,White\nB,Black\n")
    (d / "mo.txt").write_text("0100 Susp impersonate, other\n0200 Hit\n0300\n0400 Unused\n")
    (d / "st.csv").write_text("x,y,FID,DIVISION,LOCATION,PREC\n-118.25,34.05,1,CENTRAL,a,1\n-118.4,34.2,2,WEST,b,2\n")
    (d / "inc.csv").write_text("Zip Code;Community;Estimated Median Income\n90012;Downtown;$40,000\n"
                               "90049;Westside;$100,000\n")
    feats = [
        ({"CITY": "Los Angeles", "COMM": "Downtown", "ZCTA20": "90012", "POP20": 100, "HOUSING20": 40},
         _square(-118.3, 34.0, -118.2, 34.1)),
        ({"CITY": "Los Angeles", "COMM": "Westside", "ZCTA20": "90049", "POP20": 50, "HOUSING20": 20},
         _square(-118.45, 34.15, -118.35, 34.25)),
        ({"CITY": "Elsewhere", "COMM": "Other", "ZCTA20": "90012", "POP20": 7, "HOUSING20": 7},
         _square(-118.3, 34.0, -118.2, 34.1)),
        ({"CITY": "Los Angeles", "COMM": "Bad", "ZCTA20": "bad", "POP20": 7, "HOUSING20": 7},
         _square(-118.3, 34.0, -118.2, 34.1)),
    ]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": p, "geometry": {"type": "Polygon", "coordinates": c}} for p, c in feats]}
    (d / "blocks.geojson").write_text(json.dumps(doc, indent=1))
    return d, [str(d / "p1.csv"), str(d / "p2.csv")]


def test_assault_age_groups(spark, files):
    _, crimes = files
    for engine in ("native", "udf"):
        got = {r.Age_Group: r["count"] for r in R.assault_age_groups(spark, crimes, engine=engine).collect()}
        assert got == {"25-64 Adults": 1, "0-17 Children": 1, "65+ Elderly": 1, "18-24 Young Adults": 1}


def test_top_descents_per_year(spark, files):
    d, crimes = files
    got = [(r.Year, r.Vict_Descent_Full, r.Number_of_Victims, r.percent)
           for r in R.top_descents_per_year(spark, str(d / "re.csv"), crimes).collect()]
    assert got == [(2021, "Black", 1, "50.00"), (2021, "Hispanic", 1, "50.00"),
                   (2020, "Hispanic", 2, "66.67"), (2020, "White", 1, "33.33")]


@pytest.mark.parametrize("strategy", ["auto", "merge", "shuffle_hash", "broadcast"])
def test_mocode_frequency(spark, files, strategy):
    d, crimes = files
    got = [tuple(r) for r in R.mocode_frequency(spark, str(d / "mo.txt"), crimes, strategy=strategy).collect()]
    assert got == [("0100", "Susp impersonate, other", 3), ("0200", "Hit", 2), ("0300", None, 2)]


def _hav(lon1, lat1, lon2, lat2, r=6371.008):
    a = (math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2))
         * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * r * math.asin(math.sqrt(a))


@pytest.mark.parametrize("method", ["auto", "grid"])
def test_station_load(spark, files, method):
    d, crimes = files
    got = {r.DIVISION: (r.number_of_crimes, r.average_distance)
           for r in R.station_load(spark, str(d / "st.csv"), crimes, method=method).collect()}
    central = [_hav(-118.25, 34.05, -118.25, 34.05), _hav(-118.26, 34.06, -118.25, 34.05), 0.0]
    west = [_hav(-118.4, 34.2, -118.4, 34.2), _hav(-118.41, 34.21, -118.4, 34.2)]
    assert got["CENTRAL"][0] == 3 and abs(got["CENTRAL"][1] - sum(central) / 3) < 1e-9
    assert got["WEST"][0] == 2 and abs(got["WEST"][1] - sum(west) / 2) < 1e-9


def test_community_income_crime_and_correlations(spark, files):
    d, crimes = files
    roll = R.community_income_crime(spark, str(d / "inc.csv"), str(d / "blocks.geojson"), crimes)
    got = {r.COMM: (r.total_population, r.total_crime_count, r.total_income, r.crimes_per_person,
                    r.income_per_capita) for r in roll.collect()}
    assert got == {"Downtown": (100, 2, 1_600_000, 0.02, 16000.0), "Westside": (50, 2, 2_000_000, 0.04, 40000.0)}
    corr = {r.subset: r.correlation for r in R.income_crime_correlations(roll, k=1).collect()}
    assert abs(corr["all"] - 1.0) < 1e-9 and abs(corr["lowest_1_and_highest_1"] - 1.0) < 1e-9


def test_reports_on_ingested_parquet_match_csv(spark, files, tmp_path):
    from conftest import formatted_plan
    from cityscan.sources.csv import ingest_incidents

    d, crimes = files
    out = str(tmp_path / "incidents")
    ingest_incidents(spark, crimes, out)
    inc = spark.read.parquet(out)
    assert ([tuple(r) for r in R.assault_age_groups(spark, incidents=inc).collect()]
            == [tuple(r) for r in R.assault_age_groups(spark, crimes).collect()])
    assert ([tuple(r) for r in R.top_descents_per_year(spark, str(d / "re.csv"), incidents=inc).collect()]
            == [tuple(r) for r in R.top_descents_per_year(spark, str(d / "re.csv"), crimes).collect()])
    roll = R.community_income_crime(spark, str(d / "inc.csv"), str(d / "blocks.geojson"), incidents=inc)
    assert sorted(tuple(r) for r in roll.collect()) == sorted(
        tuple(r) for r in R.community_income_crime(spark, str(d / "inc.csv"), str(d / "blocks.geojson"),
                                                   crimes).collect())
    scan = spark.read.parquet(out).where("year IN (2020, 2021)")
    import re

    assert re.search(r"PartitionFilters: \[[^\]]*year", formatted_plan(scan))
