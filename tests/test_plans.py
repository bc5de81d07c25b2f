"""The jobs from CSV files to models, on a small city."""

from __future__ import annotations

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflow import schema as S
from urbanflow.plans import encoding, enrichment, exploration, modelling
from urbanflow.operators import search as R
from urbanflow.operators.encode import encode_dataset
from urbanflow.sources.calendar import holiday_calendar
from urbanflow.sources.tables import read_table
from urbanflow.streaming.rowwise import enrich_stream, write_available

AREAS = [("Old Town", "M.G. Road"), ("Old Town", "Ring/1"), ("Harbour", "Quay")]


@pytest.fixture(scope="module")
def city(tmp_path_factory):
    base = tmp_path_factory.mktemp("city")
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=37 * i) for i in range(30)]
    head = ["Date", S.AREA, S.ROAD, *S.MEASURES, S.WEATHER, S.ROADWORK]
    lines = [",".join(head)]
    for i, (d, (area, road)) in enumerate(itertools.product(days, AREAS)):
        values = [1000 + 13 * i, 20 + i % 30, 1 + i % 5 / 10, i % 100, 50, i % 4, 90 + i % 70, 40, 80, 60, 100]
        lines.append(",".join([d.isoformat(), area, road, *map(str, values), ["Rain", "Clear", "Windy"][i % 3], [" Yes", "No"][i % 2]]))
    (base / "traffic.csv").write_text("\n".join(lines) + "\n")
    head = ["datetime", *S.WEATHER_FEATURES, "sunrise", "sunset", "note"]

    def weather(path, dates, offset):
        rows = [",".join(head)]
        for d in dates:
            rows.append(",".join([d.isoformat(), *[str(offset + j) for j in range(15)], f"{d}T06:30:00", f"{d}T18:15:30", "n"]))
        path.write_text("\n".join(rows) + "\n")

    weather(base / "early.csv", [d for d in days if d.year < 2024], 1.5)
    weather(base / "late.csv", [d for d in days if d >= dt.date(2023, 7, 1)][:-1], 2.5)
    (base / "holidays.md").write_text("# 2022\nJan - 1\nFeb - 7\n")
    return base, days


@pytest.fixture(scope="module")
def enriched(spark, city):
    base, _ = city
    enrichment.stitch_weather(spark, f"{base}/early.csv", f"{base}/late.csv", f"{base}/weather.csv")
    counts = enrichment.run_enrichment(
        spark, f"{base}/traffic.csv", f"{base}/weather.csv", f"{base}/holidays.md", f"{base}/enriched", ["tempmax"]
    )
    assert counts == (90, 16 + 17 + 3)
    return f"{base}/enriched"


def test_enriched_rows(spark, city, enriched):
    _, days = city
    rows = {(r[S.DATE], r[S.ROAD]): r for r in read_table(spark, enriched).collect()}
    assert len(rows) == 90
    first = rows[days[0], "Quay"]
    assert (first["day_of_week"], first["is_holiday"], first["minutes_of_daylight"]) == ("Saturday", True, 705.5)
    assert rows[days[1], "Quay"]["is_holiday"] is True  # 7 February 2022 is listed and a Monday
    assert rows[days[0], "M.G. Road"][S.ROADWORK] is True
    missing = rows[days[-1], "Quay"]  # no weather on the last day
    assert (missing["tempmax"], missing["minutes_of_daylight"], missing["day_of_week"]) == (None, None, days[-1].strftime("%A"))
    # Before the cutoff the early export counts, after it the late one.
    assert {r["tempmax"] for (d, _), r in rows.items() if d < dt.date(2023, 7, 1)} == {1.5}


def test_missing_weather_columns(spark, city):
    base, _ = city
    table = read_table(spark, f"{base}/early.csv").drop("dew", "sunset")
    with pytest.raises(ValueError, match=r"\['dew', 'sunset'\]"):
        enrichment.daily_weather(table, ["tempmax"])


def test_encoding_and_subsets(spark, city, enriched):
    base, _ = city
    rows, columns = encoding.run_encoding(spark, enriched, f"{base}/encoded")
    assert (rows, columns) == (90, 11 + 15 + 2 + 1 + 4 + 3 + 2 + 3)
    assert encoding.run_subset_ordered(spark, f"{base}/encoded", f"{base}/ordered") == (90, 12 + 4 + 8)
    assert encoding.run_subset_stable(spark, f"{base}/encoded", f"{base}/stable") == (90, 12 + 5 + 8, [])
    assert "Road/Intersection Name_M.G. Road" in read_table(spark, f"{base}/ordered").columns
    with pytest.raises(ValueError, match="sunrise"):
        encoding.run_encoding(spark, enriched, f"{base}/never", drop=())


def test_models_on_the_encoded_table(spark, enriched):
    full = encode_dataset(read_table(spark, enriched).where("tempmax IS NOT NULL"), drop=("sunrise", "sunset"), passthrough=(S.DATE,))
    table = modelling.model_table(full)
    assert table.count() == 87
    board, summary = modelling.tuned(table, R.forest_family, {"n_estimators": [2], "max_depth": [2, 3], "max_features": ["sqrt"]}, 2)
    assert board.count() == 2 and summary.first()["test_rmse"] > 0


def test_exploration(spark, enriched):
    table = read_table(spark, enriched)
    advised = exploration.area_road_advisories(table).collect()
    assert [(r[S.AREA], r[S.ROAD]) for r in advised] == [("Harbour", "Quay"), ("Old Town", "M.G. Road"), ("Old Town", "Ring/1")]
    assert all(r["Overall Advisory"].count(" | ") >= 4 for r in advised)
    assert advised[0][S.WEATHER] == "Windy" and advised[1][S.WEATHER] == "Rain"
    assert exploration.cluster_rows(table).rows.groupBy("Cluster").count().count() == 2


def test_chart_tables(spark, enriched):
    table = read_table(spark, enriched)
    charts = {name: [r.asDict() for r in df.collect()] for name, df in exploration.chart_tables(table).items()}
    assert charts["area_by_road"][0]["Quay"] > 0 and charts["area_by_road"][0]["M.G. Road"] is None
    assert [r["label"] for r in charts["area_road_totals"]] == ["Harbour - Quay", "Old Town - M.G. Road", "Old Town - Ring/1"]
    assert sum(r["share"] for r in charts["incident_shares"]) == pytest.approx(100, abs=0.2)
    # All values are equal, so the range is widened and they fall into the middle.
    assert [r["rows"] for r in charts["capacity_histogram"]] == [0] * 10 + [90] + [0] * 9
    assert max(r["ratio"] for r in charts["congestion_by_area"]) == 1
    assert sum(r["rows"] for r in charts["speed_volume_density"]) == 90
    assert [r["n"] for r in charts["travel_time_boxes"]] == [30, 60]
    # One kind of weather per road in this city: absent pairs are 0.
    assert [r["Harbour"] > 0 for r in charts["weather_by_area"]] == [False, False, True]


def test_encoded_tables_and_weather_correlations(spark, city, enriched):
    base, _ = city
    encoded = encode_dataset(read_table(spark, enriched), drop=("sunrise", "sunset"))
    tables = {name: df.toPandas() for name, df in exploration.encoded_tables(encoded).items()}
    assert len(tables["summary"]) == len(encoded.columns) and tables["summary"]["column"].is_unique
    core = [c for c in encoded.columns if not c.startswith(tuple(S.CATEGORY_PREFIXES))]
    assert len(tables["core_correlations"]) == len(core) ** 2
    expected = encoded.toPandas().astype(float).corr()
    got = tables["core_correlations"].pivot(index="x", columns="y", values="r").loc[core, core].to_numpy(float)
    np.testing.assert_allclose(got, expected.loc[core, core].to_numpy(), atol=1e-9)
    assert list(tables["volume_correlations"]["feature"].sort_values()) == sorted(c for c in encoded.columns if c != S.VOLUME)
    daily = read_table(spark, f"{base}/weather.csv")
    for extra in ("temp", "sealevelpressure", "solarenergy", "severerisk"):
        daily = daily.withColumn(extra, F.rand(3))
    daily.write.parquet(f"{base}/weather19")
    assert exploration.weather_correlations(spark, f"{base}/weather19").count() == 19 * 19


def test_stream_equals_batch(spark, city, enriched, tmp_path):
    base, _ = city
    schema = read_table(spark, f"{base}/traffic.csv").schema
    weather = enrichment.load_weather(spark, f"{base}/weather.csv", ["tempmax"])
    holidays = holiday_calendar(spark, f"{base}/holidays.md")
    arriving = spark.readStream.schema(schema).option("header", True).csv(f"{base}/traffic.csv*")
    out = enrich_stream(arriving, weather, holidays)
    write_available(out, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got, batch = spark.read.parquet(str(tmp_path / "out")), read_table(spark, enriched)
    columns = [F.col(f"`{c}`") for c in batch.columns]
    assert got.count() == 90 and got.select(columns).exceptAll(batch.select(columns)).count() == 0
    with pytest.raises(ValueError, match="streaming"):
        enrich_stream(batch, weather, holidays)
