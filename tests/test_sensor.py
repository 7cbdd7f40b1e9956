"""Rolling features against a plain re-computation, over slices and skewed places."""

import random
from bisect import bisect_right
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hazlake.operators import sensor

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def make(seed: int, places: int, n: int, days: int):
    """Random readings and events; the first place holds half of them, with long wet spells and gaps."""
    rng = random.Random(seed)
    readings, events, seen = [], [], set()
    for i in range(n):
        place = f"p{0 if rng.random() < 0.5 else rng.randrange(places)}"
        at = START + timedelta(seconds=rng.randrange(days * 86400), microseconds=rng.choice([0, 0, 1, 500000]))
        if (place, at) in seen or (place == "p1" and 20 < (at - START).days < 55):
            continue
        seen.add((place, at))
        rain = rng.choice([None, 0.0, 1.5, 2.25]) if place != "p2" else rng.choice([1.0, 2.0] if i % 40 else [0.0])
        readings.append(
            (place, 1.0, 2.0, at.isoformat(), at.date().isoformat(),
             rng.choice([None, 20.0, 25.5, 31.0]), rng.choice([None, 50.0, 70.0]), rng.choice([None, 3.0, 9.0]),
             90.0, rain, rng.choice([None, None, 990.0, 1001.0, 1010.0]))
        )
        if rng.random() < 0.1:
            events.append((place, at + rng.choice([timedelta(hours=24), timedelta(hours=24, microseconds=1), timedelta(0)]), f"H{i % 3}"))
    return readings, events


def expected(readings, events):
    """Straight from the definitions, one place at a time."""
    out = {}
    for place in {r[0] for r in readings}:
        rows = sorted((datetime.fromisoformat(r[3]), r) for r in readings if r[0] == place)
        times = [t for t, _ in rows]
        due = sorted((t, h) for p, t, h in events if p == place)
        temps, press, prev, run = [], [], [], 0
        for i, (t, r) in enumerate(rows):
            temps.append(r[5] if r[5] is not None else (temps[-1] if temps else None))
            prev.append(press[-1] if press else None)
            press.append(r[10] if r[10] is not None else (press[-1] if press else None))
            run = run + 1 if (r[9] or 0.0) > 0 else 0

            def back(hours, values):
                lo = bisect_right(times, t - timedelta(hours=hours))
                return [v for v in values[lo:i + 1] if v is not None]

            rain = [x[9] or 0.0 for _, x in rows]
            mean = lambda v: sum(v) / len(v) if v else None
            less = lambda a, b: None if a is None or b is None else a - b
            nxt = [h for e, h in due if t < e <= t + timedelta(hours=24)]
            out[(place, t)] = (
                sum(back(3, rain)), sum(back(24, rain)), sum(back(72, rain)), max(back(24, rain)),
                max(back(24, [x[7] or 0.0 for _, x in rows])), max(back(24, [x[6] or 0.0 for _, x in rows])),
                less(temps[i], mean(back(24, temps))), less(press[i], mean(back(3, prev))), run,
                int(bool(nxt)), nxt[0] if nxt else None,
            )
    return out


NAMES = [
    "rainfall_3h_sum", "rainfall_24h_sum", "rainfall_72h_sum", "rainfall_24h_max", "wind_24h_max",
    "humidity_24h_max", "temp_change_24h", "pressure_drop_3h", "consecutive_rain_readings",
    "hazard_within_24h", "upcoming_hazard_type",
]
SCHEMA = (
    "location_name string, lat double, lon double, collected_at string, date_partition string, temperature_c double,"
    " humidity_pct double, wind_speed_ms double, wind_dir_deg double, rainfall_mm double, pressure_hpa double"
)


def run(spark, readings, events, **options):
    df = spark.createDataFrame(readings, SCHEMA)
    ev = spark.createDataFrame(events, "location_name string, ts timestamp, hazard_type string") if events else None
    rows = sensor.sensor_features(df, ev, **options).withColumn("us", F.unix_micros("collected_at")).collect()
    return {
        (r["location_name"], START + timedelta(microseconds=r["us"] - int(START.timestamp()) * 1_000_000)): tuple(r[n] for n in NAMES)
        for r in rows
    }


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) < 1e-9
    return a == b


@pytest.mark.parametrize("cells,seed", [(None, 1), (1, 1), (2, 2), (3, 3), (10, 4)])
def test_features_equal_recomputation(spark, cells, seed):
    readings, events = make(seed, 4, 700, 80)
    want = expected(readings, events)
    got = run(spark, readings, events, slice_cells=cells)
    assert got.keys() == want.keys()
    bad = [(k, got[k], want[k]) for k in want if not all(close(a, b) for a, b in zip(got[k], want[k]))]
    assert not bad, bad[:3]


def one_place(values, column, hours):
    """Readings at the given hours with one value column set."""
    index = {"temp": 5, "rain": 9, "pres": 10}[column]
    rows = []
    for h, v in zip(hours, values):
        at = START + timedelta(hours=h)
        row = ["a", 1.0, 2.0, at.isoformat(), at.date().isoformat(), None, None, None, None, None, None]
        row[index] = v
        rows.append(tuple(row))
    return rows


def column(got, name):
    return [v[NAMES.index(name)] for _, v in sorted(got.items())]


def test_frames_are_right_closed(spark):
    got = run(spark, one_place([1.0, 2.0, 8.0], "rain", [0, 3, 4]), [])
    assert column(got, "rainfall_3h_sum") == [1.0, 2.0, 10.0]


def test_pressure_drop_uses_previous_readings(spark):
    got = run(spark, one_place([1000.0, 990.0, 985.0], "pres", [0, 1, 2]), [])
    assert column(got, "pressure_drop_3h") == [None, -10.0, -10.0]


def test_rain_run(spark):
    got = run(spark, one_place([0.0, 1.0, 2.0, 0.0, 3.0], "rain", range(5)), [])
    assert column(got, "consecutive_rain_readings") == [0, 1, 2, 0, 1]


def test_label_bounds(spark):
    reading = one_place([0.0], "rain", [0])
    at = lambda **kw: [("a", START + timedelta(**kw), "FLOOD")]
    assert column(run(spark, reading, at()), "hazard_within_24h") == [0]
    assert column(run(spark, reading, at(hours=24)), "upcoming_hazard_type") == ["FLOOD"]
    assert column(run(spark, reading, at(hours=24, microseconds=1)), "hazard_within_24h") == [0]
    tie = at(hours=2) + [("a", START + timedelta(hours=2), "CYCLONE")]
    assert column(run(spark, reading, tie), "upcoming_hazard_type") == ["CYCLONE"]


def test_times_of_every_form_are_kept_and_noise_is_not(spark):
    rows = one_place([1.0, 1.0, 1.0], "rain", [0, 1, 2])
    forms = ["2024-01-01T00:00:00+00:00", "2024-01-01T01:00:00.250000+00:00", "12:30"]
    rows = [r[:3] + (f,) + r[4:] for r, f in zip(rows, forms)]
    assert column(run(spark, rows, []), "consecutive_rain_readings") == [1, 2]


def test_warmup_keeps_history(spark):
    rows = one_place([1.0, 2.0], "rain", [23, 25])
    df = spark.createDataFrame(rows, SCHEMA)
    cut = sensor.readings_between(df, start="2024-01-02")
    warm = sensor.readings_between(df, start="2024-01-02", warmup_days=3)
    total = lambda d, **kw: [r[0] for r in sensor.sensor_features(d, **kw).select("rainfall_3h_sum").collect()]
    assert total(cut) == [2.0]
    assert total(warm, output_from="2024-01-02") == [3.0]


@pytest.mark.parametrize("cells", [None, 1, 10])
def test_values_that_are_no_finite_number_are_missing(spark, cells):
    readings, events = make(7, 3, 300, 40)
    rng = random.Random(8)
    odd, missing = [], []
    for r in readings:
        spoilt = {k for k in (5, 6, 7, 9, 10) if rng.random() < 0.1}
        odd.append(tuple(rng.choice([float("nan"), float("inf"), float("-inf")]) if k in spoilt else v for k, v in enumerate(r)))
        missing.append(tuple(None if k in spoilt else v for k, v in enumerate(r)))
    want = expected(missing, events)
    got = run(spark, odd, events, slice_cells=cells)
    assert got.keys() == want.keys()
    bad = [(k, got[k], want[k]) for k in want if not all(close(a, b) for a, b in zip(got[k], want[k]))]
    assert not bad, bad[:3]


def test_label_without_frames_reads_no_edges(spark):
    readings, events = make(3, 3, 200, 30)
    df = spark.createDataFrame(readings, SCHEMA)
    ev = spark.createDataFrame(events, "location_name string, ts timestamp, hazard_type string")
    whole, narrow = sensor.sensor_features(df, ev), sensor.sensor_features(df, ev, frames=False)
    assert set(whole.columns) - set(narrow.columns) == set(sensor.FRAMES)
    keyed = lambda rows: sorted(rows.select(*narrow.columns).collect(), key=repr)
    assert keyed(whole) == keyed(narrow)
    assert "_edge" in whole._jdf.queryExecution().toString() and "_edge" not in narrow._jdf.queryExecution().toString()


@pytest.mark.parametrize("frames", [True, False])
def test_a_place_is_many_window_keys(spark, frames):
    """What a task holds of a place is some hours of it, and no reading is held twice."""
    rows = spark.createDataFrame(one_place([1.0] * 48, "rain", range(48)), SCHEMA)
    out = sensor.feature_rows(rows, frames=frames)
    assert [(r["count"]) for r in out.groupBy("slice").count().collect()] == [3] * 16
