"""From record lines to a stored forecast, the way a deployment runs."""

import datetime as dt
import math

from miasma.operators import clean
from miasma.plans import bootstrap, incremental
from miasma.sinks.points import write_lines
from miasma.operators.points import prediction_points
from miasma.sources import files, payload
from miasma.streaming import daily
from miasma.streaming.sources import stream_lines
from tests.records import HEADER, line, record

MEASURES = ["TEMP", "PRCP", "DEWP"]
SMALL = {"numTrees": 5, "maxDepth": 4}


def lines(first: dt.date, days: int) -> list[str]:
    made = [line(HEADER)]
    for d in range(days):
        date = first + dt.timedelta(d)
        warmth = 60 + 20 * math.sin(date.timetuple().tm_yday / 58)
        made.append(line(record(DATE=date.isoformat(), TEMP=f"{warmth:6.1f}", PRCP=" 0.25")))
    return made


def test_records_to_forecast(spark, tmp_path):
    history, feed, days = (tmp_path / n for n in ("history", "feed", "daily"))
    history.mkdir(), feed.mkdir()
    (history / "2023.csv").write_text("\n".join(lines(dt.date(2023, 1, 2), 364)) + "\n")
    (tmp_path / "cases.csv").write_text(
        "city,year,weekofyear,total_cases\ncity,year,weekofyear,total_cases\n"
        + "".join(f"sj,2023,{w},{10 + w % 7}\n" for w in range(1, 53))
        + "".join(f"sj,2024,{w},{12 + w % 5}\n" for w in range(1, 5)) + "iq,2023,1,0\n")

    store = bootstrap.Store(spark, str(tmp_path / "store"))
    cases = clean.region_filter(files.read_cases_csv(spark, str(tmp_path / "cases.csv")), "sj")
    obs = clean.sentinel_to_null(clean.clean_records(files.read_observation_csv(spark, str(history))))
    quality = bootstrap.bootstrap(store, obs, cases, MEASURES, **SMALL).first()
    assert 0 < quality.n < 52 and quality.mape is not None

    def stream():
        means = daily.daily_stream(payload.text_payload(stream_lines(spark, str(feed))), MEASURES,
                                   null_sentinels=True)
        daily.run_available(means, str(days), str(tmp_path / "checkpoint"), files_per_batch=1)
        return incremental.merge_new_files(store, str(days), MEASURES)

    (feed / "a.csv").write_text("\n".join(lines(dt.date(2024, 1, 1), 30)) + "\n")
    assert stream() == 1
    (feed / "b.csv").write_text("\n".join(lines(dt.date(2024, 1, 31), 30)) + "\n")
    assert stream() == 2
    assert incremental.merge_new_files(store, str(days), MEASURES) is None

    weekly = store.weekly.read().filter("Weather_Year = 2024")
    assert weekly.agg({"record_count": "sum"}).first()[0] == 60 - 7
    before = store.training.read().count()
    incremental.retrain(store, cases, **SMALL)
    assert store.training.read().count() == before + 4
    assert bootstrap.evaluate(store).first().n >= quality.n

    forecast = incremental.forecast(store, cases)
    assert sorted((r.year, r.weekofyear) for r in forecast.collect()) == [(2024, w) for w in (5, 6, 7, 8)]
    assert store.predictions.read().count() == 4
    points = prediction_points(forecast, predicted="Prediction Cases")
    write_lines(points, str(tmp_path / "points"))
    assert spark.read.text(str(tmp_path / "points")).filter("value LIKE 'predicted_cases,year=2024 weekofyear=%'").count() == 4
