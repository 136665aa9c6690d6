import pytest
from helpers import as_set

from omnibus.plans import jobs
from omnibus.sources import quarantine, tables


def write(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / name.replace("__", ".")).write_text(text)
    return str(folder)


def test_lines_with_other_fields_than_the_header(spark, tmp_path):
    text = 'stop_lat,stop_id,stop_name,stop_lon\n28.5,a,"A, b",77.1\n28.5,b\n1,2,3,4,5\n,c,,\n28.6,"d ""x""",D,77\n'
    folder = write(tmp_path / "g", stops__txt=text)
    landed = quarantine.read_csv(spark, f"{folder}/stops.txt", "stops")
    assert as_set(landed.good.select("stop_id", "stop_name", "stop_lat")) == {
        ("a", "A, b", "28.5"), ("c", None, None), ('d "x"', "D", "28.6")
    }
    got = landed.broken.collect()
    assert {(r.source, r.record) for r in got} == {("stops", "28.5,b"), ("stops", "1,2,3,4,5")}
    assert all(r.file.endswith("stops.txt") for r in got)


def test_typed_fields_and_documents(spark, tmp_path):
    folder = write(
        tmp_path / "f", fuel__csv="date,petrol_delhi_inr,diesel_delhi_inr,source_note\n2024-01-01,90.5,80,s\n2024-01-02,soon,81,s\n",
        good__json=(
            '{"daily": {"time": ["2024-01-01"], "temperature_2m_max": [30.0], "temperature_2m_min": [20.0],'
            ' "precipitation_sum": [1.0], "windspeed_10m_max": [9.0], "weathercode": [3]}}'
        ), bad__json='{"daily": {"time": [',
    )
    fuel = quarantine.read_fuel(spark, f"{folder}/fuel.csv")
    assert as_set(fuel.good.select("date", "petrol_delhi_inr")) == {("2024-01-01", 90.5)}
    assert [r.record for r in fuel.broken.collect()] == ["2024-01-02,soon,81,s"]
    weather = quarantine.read_weather(spark, f"{folder}/*.json")
    assert as_set(weather.good.select("date", "weather_code")) == {("2024-01-01", 3)}
    assert [(r.source, r.file.rsplit("/", 1)[1]) for r in weather.broken.collect()] == [("weather", "bad.json")]


def test_observations_with_line_breaks(spark, tmp_path):
    folder = write(tmp_path / "o", o__csv='id,description,status\n1,"two\nlines",NEW\n2,short\n3,,NEW\n')
    landed = quarantine.read_observations(spark, f"{folder}/o.csv")
    assert as_set(landed.good.select("id", "description", "status")) == {("1", "two\nlines", "NEW"), ("3", "", "NEW")}
    assert [r.record for r in landed.broken.collect()] == ["2,short"]


def test_files_without_broken_records(spark, tmp_path):
    folder = write(tmp_path / "e", a__csv="x,y\n1,2\n", b__csv="x,y\n")
    for name in ("a", "b"):
        landed = quarantine.read_csv(spark, f"{folder}/{name}.csv", "t")
        assert landed.broken.count() == 0 and landed.good.count() == (name == "a")


def test_the_table_counts_copies_and_a_file_once(spark, tmp_path):
    folder = write(tmp_path / "c", a__csv="x,y\n1\n1\n2\n3,4\n", b__csv="x,y\n1\n")
    for _ in range(2):
        broken = [quarantine.read_csv(spark, f"{folder}/{n}.csv", "t").broken for n in "ab"]
        quarantine.store(broken, "quar.broken", str(tmp_path / "lake"))
    got = {(r.file.rsplit("/", 1)[1], r.n_broken) for r in quarantine.counts(spark, "quar.broken").collect()}
    assert got == {("a.csv", 3), ("b.csv", 1)}


def test_reload_loads_the_good_records(spark, tmp_path):
    from test_jobs import TEXTS, landed

    files = landed(tmp_path, stops=TEXTS["stops"] + "c,C\n", stop_times=TEXTS["stop_times"] + "t2,b,2,13:00:00,13:00:00,more\n")
    jobs.reload_warehouse(spark, *files, str(tmp_path / "lake"), "quar_silver", "quar_gold")
    assert as_set(spark.table("quar_gold.dim_stop").select("stop_id")) == {("a",), ("b",)}
    assert spark.table("quar_gold.fact_schedule").count() == 3
    got = {(r.source, r.record) for r in tables.read(spark, f"quar_silver.{jobs.BROKEN_RECORDS}").collect()}
    assert got == {("stops", "c,C"), ("stop_times", "t2,b,2,13:00:00,13:00:00,more")}


@pytest.mark.parametrize("reader", ["csv", "json"])
def test_one_scan_for_each_side(spark, tmp_path, reader):
    folder = write(tmp_path / "s", a__csv="x,y\n1,2\n", a__json='{"x": 1}\n')
    landed = (
        quarantine.read_csv(spark, f"{folder}/a.csv", "t", "x int, y int") if reader == "csv"
        else quarantine.read_json(spark, f"{folder}/a.json", "t", "x int", one_per_line=True)
    )
    for df in (landed.good, landed.broken):
        assert df._jdf.queryExecution().executedPlan().toString().count(f"Scan {reader}") == 1
    assert landed.good.columns == (["x", "y"] if reader == "csv" else ["x"])
