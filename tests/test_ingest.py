from pyspark.sql import functions as F

from cityscan.sources.csv import INCIDENT_SCHEMA, ingest_incidents
from cityscan.streaming import start_incident_ingest

HEADER = ",".join(f.name for f in INCIDENT_SCHEMA.fields)


def _row(dr, date, age, lat, lon):
    cells = [dr, "", date] + [""] * 8 + [str(age), "M", "H"] + [""] * 12 + [str(lat), str(lon)]
    return ",".join(cells)


def _write(path, rows):
    path.write_text(HEADER + "\n" + "\n".join(rows) + "\n")


def test_batch_ingest_parses_once_and_partitions_by_year(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    _write(src / "a.csv", [_row("1", "2020 Jan 05 01:30:00 PM", 30, 34.0, -118.2),
                           _row("2", "2021 Feb 01 12:00:00 AM", 40, 34.1, -118.3),
                           _row("3", "bad date", 50, 0, 0)])
    out = str(tmp_path / "out")
    ingest_incidents(spark, str(src / "a.csv"), out)
    df = spark.read.parquet(out)
    assert sorted((r.DR_NO, r.year) for r in df.select("DR_NO", "year").collect()) == [
        ("1", 2020), ("2", 2021), ("3", None)]
    assert "Vict_Age" in df.columns and "ts_occ" in df.columns


def test_stream_ingest_processes_each_file_once(spark, tmp_path):
    src = tmp_path / "drop"
    src.mkdir()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write(src / "p1.csv", [_row("1", "2020 Jan 05 01:30:00 PM", 30, 34.0, -118.2)])
    _write(src / "p2.csv", [_row("2", "2021 Jan 05 01:30:00 PM", 31, 34.0, -118.2)])
    q = start_incident_ingest(spark, str(src), out, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    _write(src / "p3.csv", [_row("3", "2021 Mar 05 01:30:00 PM", 32, 34.0, -118.2)])
    q = start_incident_ingest(spark, str(src), out, ckpt)  # restart from the checkpoint
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert sorted(r.DR_NO for r in got.collect()) == ["1", "2", "3"]
    assert got.where(F.col("year") == 2021).count() == 2


def test_unclustered_ingest_writes_the_same_rows(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    _write(src / "a.csv", [_row(str(i), f"202{i % 2} Jan 0{i % 9 + 1} 01:30:00 PM", 30, 34.0, -118.2)
                           for i in range(20)])
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    ingest_incidents(spark, str(src / "a.csv"), a)
    ingest_incidents(spark, str(src / "a.csv"), b, clustered=False)
    rows = lambda p: sorted(tuple(r) for r in spark.read.parquet(p).select("DR_NO", "year", "ts_occ").collect())
    assert rows(a) == rows(b) and len(rows(a)) == 20


def test_a_restart_in_another_session_loses_no_file(spark, tmp_path):
    import pytest

    src = tmp_path / "drop"
    src.mkdir()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write(src / "a.csv", [_row("1", "2020 Jan 05 01:30:00 PM", 30, 34.0, -118.2)])
    start_incident_ingest(spark, str(src), out, ckpt).awaitTermination(120)
    _write(src / "b.csv", [_row("2", "2020 Feb 05 01:30:00 PM", 30, 34.0, -118.2)])
    other = spark.newSession()
    start_incident_ingest(other, str(src), out, ckpt).awaitTermination(120)
    assert sorted(r.DR_NO for r in other.read.parquet(out).collect()) == ["1", "2"]
    with pytest.raises((TypeError, ValueError)):
        start_incident_ingest(spark, str(src), out, "")


def test_bad_rows_are_kept_apart_and_a_restart_repeats_nothing(spark, tmp_path, monkeypatch):
    import pytest

    from cityscan.streaming import ingest

    src = tmp_path / "drop"
    src.mkdir()
    out, bad, ckpt = (str(tmp_path / x) for x in ("out", "bad", "ckpt"))
    good_row, broken = _row("1", "2020 Jan 05 01:30:00 PM", 30, 34.0, -118.2), _row("2", "2020 Jan 06 01:30:00 PM", "x7", 34.0, -118.2)
    _write(src / "a.csv", [good_row, broken, "3,too short"])
    run = lambda: ingest.start_incident_ingest_checked(spark, str(src), out, bad, ckpt).awaitTermination(120)
    run()
    _write(src / "b.csv", [_row("4", "2021 Feb 05 01:30:00 PM", 30, 34.0, -118.2), _row("5", "bad date", 30, "north", -118.2)])
    with monkeypatch.context() as m:  # the second batch stops between its two writes
        write = ingest.write_batch

        def half(batch, batch_id, out_path, quarantine_path, ts_format):
            write(batch, batch_id, out_path, str(tmp_path / "lost"), ts_format)
            raise RuntimeError("stopped")

        m.setattr(ingest, "write_batch", half)
        with pytest.raises(Exception, match="stopped"):
            run()
    run()
    run()  # nothing new
    assert sorted(r.DR_NO for r in spark.read.parquet(out).collect()) == ["1", "4"]
    rows = sorted(spark.read.parquet(bad).collect(), key=lambda r: r.line)
    assert [r.line.split(",")[0] for r in rows] == ["2", "3", "5"]
    assert rows[0].line == broken and rows[0].file.endswith("a.csv") and rows[2].file.endswith("b.csv")
    assert rows[0].parsed["Vict Age"] is None and rows[0].parsed["LAT"] == 34.0 and rows[0].batch_id != rows[2].batch_id
