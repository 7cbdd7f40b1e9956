"""Rolling sensor features with forward-looking hazard labels.

Time frames are right-closed, ``(t - w, t]``. Readings and hazard events of a
place go through one window pass, so a label is a frame over later event rows
and no range join is needed.

A place may hold a large share of all readings, so the window key is
(place, slice), not place, and a slice is three hours, which divides all frames:
what a task holds grows with the readings of some hours and not of days. No reading is
copied to another slice. A slice gets one carry row instead, dropped again afterwards, with
what the windows would know of other slices: the last temperature and pressure, the length
of the running wet spell, sums and maxima of the whole slices inside each frame, and
the next hazard event after the slice.

The carry comes from a small table with one row per cell (slice of a place) that has readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazlake.functions.times import calendar_parts, parse_iso

HOUR = 3_600_000_000  # microseconds
EDGES = (3, 24, 72)  # hours of the frames
CELL_HOURS = 3
CELL = CELL_HOURS * HOUR
LABEL = 24 * HOUR

VALUES = ["temperature_c", "humidity_pct", "wind_speed_ms", "wind_dir_deg", "rainfall_mm", "pressure_hpa"]

#: Columns over look-back frames; all others come from the window pass alone.
FRAMES = [
    "temp_change_24h", "humidity_24h_max", "wind_24h_max", "rainfall_3h_sum", "rainfall_24h_sum", "rainfall_72h_sum",
    "rainfall_24h_max", "pressure_drop_3h",
]

# The exported columns.
COLUMNS = [
    "location_name", "lat", "lon", "collected_at", "date_partition", "temperature_c",
    "temp_change_24h", "humidity_pct", "humidity_24h_max", "wind_speed_ms", "wind_dir_deg",
    "wind_24h_max", "rainfall_mm", "rainfall_3h_sum", "rainfall_24h_sum", "rainfall_72h_sum",
    "rainfall_24h_max", "pressure_hpa", "pressure_drop_3h", "consecutive_rain_readings",
    "month", "hour", "day_of_year", "hazard_within_24h", "upcoming_hazard_type",
]

READING, EVENT, CARRY = 0, 1, 2


def hazard_events(lake: DataFrame) -> DataFrame:
    """(location_name, ts, hazard_type) of labelled records that are not weather readings."""
    return (
        lake.filter(F.col("hazard_type").isNotNull() & (F.col("source_type") != "weather"))
        .select("location_name", parse_iso(F.col("collected_at")).alias("ts"), "hazard_type")
        .filter(F.col("location_name").isNotNull() & F.col("ts").isNotNull())
    )


def readings_between(
    weather: DataFrame, start: str | None = None, end: str | None = None, warmup_days: int = 0
) -> DataFrame:
    """Readings by date, cut before the windows; ``warmup_days`` keeps earlier ones as history."""
    out = weather
    if start:
        first = F.date_format(F.date_sub(F.lit(start).cast("date"), warmup_days), "yyyy-MM-dd")
        out = out.filter(F.col("date_partition") >= (first if warmup_days else F.lit(start)))
    if end:
        out = out.filter(F.col("date_partition") <= end)
    return out


def _bucket(value: Column, width: int) -> Column:
    """Floor division that stays exact (no rounding of large microsecond counts)."""
    return ((value - F.pmod(value, F.lit(width))) / width).cast("bigint")


def _timed(readings: DataFrame) -> DataFrame:
    """Readings with a usable time and place: ``us`` (microseconds), ``cell``, ``wet``; values that are no finite number are missing."""
    ts = parse_iso(F.col("collected_at"))
    # NaN is greater than infinity, so one comparison finds both. Running totals would carry either into all later frames.
    finite = {name: F.when(F.abs(F.col(name)) < float("inf"), F.col(name)) for name in VALUES if name in readings.columns}
    return (
        readings.withColumns({"ts": ts, **finite})
        .filter(F.col("ts").isNotNull() & F.col("location_name").isNotNull())
        .withColumn("us", F.unix_micros("ts"))
        .withColumn("cell", _bucket(F.col("us"), CELL))
        .withColumn("wet", F.coalesce(F.col("rainfall_mm"), F.lit(0.0)) > 0)
    )


def _order(*more: str):
    return [F.col("us"), *[F.col(c) for c in more]]


def _cell_states(timed: DataFrame) -> DataFrame:
    """Per (place, cell): what its readings alone say; ``temp_nulls`` and ``prev_nulls`` count those that wait for an earlier value.

    One shuffle of a few narrow columns.
    """
    so_far = Window.partitionBy("location_name", "cell").orderBy(*_order("collected_at"))
    first = Window.unboundedPreceding
    names = ("temperature_c", "pressure_hpa", "rainfall_mm", "wind_speed_ms", "humidity_pct")
    narrow = timed.select("location_name", "cell", "us", "collected_at", "wet", *names)
    filled = narrow.withColumns(
        {
            "temp": F.last("temperature_c", ignorenulls=True).over(so_far.rowsBetween(first, 0)),
            "pres": F.last("pressure_hpa", ignorenulls=True).over(so_far.rowsBetween(first, 0)),
            "prev": F.last("pressure_hpa", ignorenulls=True).over(so_far.rowsBetween(first, -1)),
            "index": F.row_number().over(so_far),
        }
    )
    dry = F.max(F.when(~F.col("wet"), F.col("index")))
    return filled.groupBy("location_name", "cell").agg(
        F.max_by("temp", "index").alias("temp"), F.max_by("pres", "index").alias("pres"), dry.isNotNull().alias("has_dry"),
        (F.max("index") - F.coalesce(dry, F.lit(0))).cast("bigint").alias("wet_tail"), F.count("*").alias("n"),
        *[
            column
            for name in ("temp", "prev")
            for column in (F.coalesce(F.sum(name), F.lit(0.0)).alias(f"{name}_sum"), F.count_if(F.col(name).isNull()).alias(f"{name}_nulls"))
        ],
        F.sum(F.coalesce("rainfall_mm", F.lit(0.0))).alias("rain_sum"),
        *[
            F.max(F.coalesce(name, F.lit(0.0))).alias(f"max{short}")
            for name, short in (("rainfall_mm", "_rain"), ("wind_speed_ms", "_wind"), ("humidity_pct", "_humi"))
        ],
    )


#: What a carry row says of the whole cells inside the frames of its cell's readings.
MIDDLES = ["_mid_rain24", "_mid_rain72", "_mid_temp24", "_mid_ntemp24", "_midmax_rain", "_midmax_wind", "_midmax_humi"]


def _carry_rows(timed: DataFrame, events: DataFrame | None) -> DataFrame:
    """One row per cell with readings: the state before it, whole cells of its frames, and the next event after it."""
    states = _cell_states(timed)
    if events is None:
        states = states.withColumn("first_event", F.lit(None).cast("struct<us: bigint, hazard_type: string>"))
    else:
        at = events.select("location_name", _bucket(F.col("us"), CELL).alias("at"), F.struct("us", "hazard_type").alias("event"))
        firsts = at.groupBy("location_name", "at").agg(F.min("event").alias("first_event"))
        states = states.unionByName(firsts.withColumnRenamed("at", "cell"), allowMissingColumns=True)
    by_cell = Window.partitionBy("location_name").orderBy("cell")
    before = by_cell.rangeBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("location_name").orderBy(F.desc("cell")).rangeBetween(Window.unboundedPreceding, -1)
    states = states.withColumns(
        {
            "temp_before": F.last("temp", ignorenulls=True).over(before),
            "pres_before": F.last("pres", ignorenulls=True).over(before),
            "wet_before": F.coalesce(F.sum("wet_tail").over(before), F.lit(0)),
            "_ahead": F.min("first_event").over(later),
        }
    )
    waiting = F.col("temp_nulls")
    states = states.withColumns(
        {
            # A wet spell runs from the end of the last cell with a dry reading.
            "dry_before": F.last(F.when(F.col("has_dry"), F.col("wet_before")), ignorenulls=True).over(before),
            "temp_sum": F.col("temp_sum") + F.coalesce(waiting * F.col("temp_before"), F.lit(0.0)),
            "temp_n": F.col("n") - F.when(F.col("temp_before").isNull(), waiting).otherwise(0),
        }
    )

    def inside(hours: int, total: Column) -> Column:
        return total.over(by_cell.rangeBetween(1 - hours // CELL_HOURS, -1))

    middles = [
        F.coalesce(inside(24, F.sum("rain_sum")), F.lit(0.0)), F.coalesce(inside(72, F.sum("rain_sum")), F.lit(0.0)),
        F.coalesce(inside(24, F.sum("temp_sum")), F.lit(0.0)), F.coalesce(inside(24, F.sum("temp_n")), F.lit(0)),
        *[inside(24, F.max(f"max{name}")) for name in ("_rain", "_wind", "_humi")],
    ]
    return states.withColumns(dict(zip(MIDDLES, middles))).filter("n IS NOT NULL").select(
        "location_name", F.col("cell").alias("slice"), (F.col("cell") * CELL - 1).alias("us"),
        F.col("temp_before").alias("temperature_c"), F.col("pres_before").alias("pressure_hpa"),
        (F.col("wet_before") - F.coalesce("dry_before", F.lit(0))).alias("weight"), F.lit(CARRY).alias("kind"), "_ahead", *MIDDLES,
    )


def _with_features(rows: DataFrame, frames: bool) -> DataFrame:
    """The window pass over mixed rows (readings, events, carry); ``frames`` adds the look-back frames."""
    key = Window.partitionBy("location_name", "slice")
    by_row = key.orderBy(*_order("collected_at"))
    so_far = by_row.rowsBetween(Window.unboundedPreceding, 0)
    before = by_row.rowsBetween(Window.unboundedPreceding, -1)
    is_reading = F.col("kind") == READING

    def zero_filled(name: str) -> Column:
        return F.when(is_reading, F.coalesce(F.col(name), F.lit(0.0)))

    rows = rows.withColumns({"_rain": zero_filled("rainfall_mm"), "_wind": zero_filled("wind_speed_ms"), "_humi": zero_filled("humidity_pct")})
    # The carry row comes first in its slice, so the last value known so far reaches all readings.
    rows = rows.withColumns(
        {
            "temp_filled": F.when(is_reading, F.last("temperature_c", ignorenulls=True).over(so_far)),
            "pres_filled": F.when(is_reading, F.last("pressure_hpa", ignorenulls=True).over(so_far)),
            # The previous reading's filled value is the last known value strictly before this row.
            "_prev_pres": F.when(is_reading, F.last("pressure_hpa", ignorenulls=True).over(before)),
            "_index": F.sum("weight").over(so_far),
            **{name: F.last(name, ignorenulls=True).over(so_far) for name in ["_ahead", *(MIDDLES if frames else [])]},
        }
    )
    rows = rows.withColumn(
        "_dry_index", F.last(F.when(is_reading & ~F.col("wet"), F.col("_index")), ignorenulls=True).over(so_far)
    )
    event = F.when(F.col("kind") == EVENT, F.struct("us", "hazard_type"))
    rows = rows.withColumns(
        {
            "consecutive_rain_readings": F.col("_index") - F.coalesce("_dry_index", F.lit(0)),
        }
    )
    # Running from the latest row backwards, the least event seen so far is the next one to come:
    # one pass, where a forward frame would be read again for every row.
    later = key.orderBy(F.desc("us")).rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_later", F.coalesce(F.min(event).over(later), F.col("_ahead"))).filter(is_reading)
    rows = rows.withColumn("_next", F.when(F.col("_later.us") <= F.col("us") + LABEL, F.col("_later"))).drop("_later", "_ahead")
    return _with_frames(rows) if frames else rows


def _with_frames(readings: DataFrame) -> DataFrame:
    """Sums, means and maxima over the frames ``(t - w, t]``, in time that grows with the rows alone.

    A frame is the reading's cell up to the reading, whole cells (from the carry row), and in the cell of the
    frame's left edge what follows ``t - w``. That end is found by a mark there: a narrow row, no copy of the reading.
    All window frames only grow, so none is read again for every row, however many readings it holds.
    """
    summed, peaks = {"_rain": EDGES, "temp_filled": (24,), "_prev_pres": (3,)}, ("_rain", "_wind", "_humi")
    until = Window.partitionBy("location_name", "slice").orderBy("us").rangeBetween(Window.unboundedPreceding, 0)
    readings = readings.withColumns(
        {f"_sum{name}": F.coalesce(F.sum(name).over(until), F.lit(0.0)) for name in summed}
        | {f"_n{name}": F.count(name).over(until) for name in summed}
        | {f"_max{name}": F.max(name).over(until) for name in peaks}
    )
    values = ["_rain", "_wind", "_humi", "temp_filled", "_prev_pres"]
    edge = F.col("_edge")
    marked = readings.select(
        "location_name", F.col("us").alias("_at"), F.col("slice").alias("_cell"), *values,
        F.struct(*[c for c in readings.columns if c not in ("location_name", *values)]).alias("_all"),
        F.explode(F.array(*[F.lit(w) for w in (0, *EDGES)])).alias("_edge"),
    )
    marked = marked.select(
        "location_name", "_at", "_edge", (F.col("_at") - edge * HOUR).alias("_us"), (F.col("_cell") - (edge / CELL_HOURS).cast("int")).alias("_block"),
        *[F.when(edge == 0, F.col(c)).alias(c) for c in (*values, "_all")],
    )
    after = Window.partitionBy("location_name", "_block").orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, -1)
    ends = {f"_past{name}": F.sum(name).over(after) for name in summed} | {f"_npast{name}": F.count(name).over(after) for name in summed}
    marked = marked.withColumns(ends | {f"_pastmax{name}": F.max(name).over(after) for name in peaks})

    own = Window.partitionBy("location_name", "_at")

    def at_edge(column: str, hours: int) -> Column:
        return F.max(F.when(edge == hours, F.col(column))).over(own)

    at = {f"_end{name}{w}": F.coalesce(at_edge(f"_past{name}", w), F.lit(0.0)) for name, hours in summed.items() for w in hours}
    at |= {f"_nend{name}{w}": at_edge(f"_npast{name}", w) for name, hours in summed.items() for w in hours}
    at |= {f"_endmax{name}": at_edge(f"_pastmax{name}", 24) for name in peaks}
    joined = marked.withColumns(at).filter("_edge = 0").select("location_name", *values, *at, "_all.*")

    def exact(column: Column) -> Column:
        """Without the last bits that sums in another order leave."""
        return F.round(column, 9)

    def total(name: str, hours: int, middle: str | None = None, n: str = "sum", end: str = "_end") -> Column:
        whole = F.col(f"_{n}{name}") + F.col(f"{end}{name}{hours}")
        return whole + F.col(middle) if middle else whole

    def mean(name: str, hours: int, middle: str | None = None, middles: str | None = None) -> Column:
        return F.try_divide(total(name, hours, middle), total(name, hours, middles, "n", "_nend"))

    return joined.withColumns(
        {
            "rainfall_3h_sum": exact(total("_rain", 3)),
            **{f"rainfall_{w}h_sum": exact(total("_rain", w, f"_mid_rain{w}")) for w in (24, 72)},
            **{out: F.greatest(f"_max{name}", f"_midmax{name}", f"_endmax{name}") for out, name in (("rainfall_24h_max", "_rain"), ("wind_24h_max", "_wind"), ("humidity_24h_max", "_humi"))},
            "temp_change_24h": exact(F.col("temp_filled") - mean("temp_filled", 24, "_mid_temp24", "_mid_ntemp24")),
            "pressure_drop_3h": exact(F.col("pres_filled") - mean("_prev_pres", 3)),
        }
    )


def feature_rows(
    readings: DataFrame,
    events: DataFrame | None = None,
    slice_cells: int | None = None,
    output_from: str | None = None,
    frames: bool = True,
) -> DataFrame:
    """Readings with all features, and the forward-filled ``temp_filled`` and ``pres_filled``.

    ``events`` has (location_name, ts, hazard_type). ``slice_cells``, once the width of a slice, changes nothing:
    slices are always one cell. ``output_from`` drops warm-up rows before that date. Without
    ``frames`` the columns in ``FRAMES`` are left out, and with them the rows at the frames' edges.
    A value that is NaN or infinite counts as missing.
    """
    timed = _timed(readings)
    found = None if events is None else events.select("location_name", F.unix_micros("ts").alias("us"), "hazard_type")
    rows = timed.withColumns({"slice": F.col("cell"), "kind": F.lit(READING), "weight": F.lit(1).cast("bigint")})
    rows = rows.unionByName(_carry_rows(timed, found), allowMissingColumns=True)
    if found is None:
        rows = rows.withColumn("hazard_type", F.lit(None).cast("string"))
    else:
        own = {"slice": _bucket(F.col("us"), CELL), "kind": F.lit(EVENT), "weight": F.lit(0).cast("bigint")}
        rows = rows.unionByName(found.withColumns(own), allowMissingColumns=True)
    out = _with_features(rows, frames)
    if output_from:
        out = out.filter(F.col("date_partition") >= output_from)
    return out.withColumns(
        {
            **calendar_parts(F.col("ts")),
            "hazard_within_24h": F.when(F.col("_next").isNotNull(), 1).otherwise(0),
            "upcoming_hazard_type": F.col("_next.hazard_type"),
            "collected_at": F.col("ts"),
        }
    )


def sensor_features(readings: DataFrame, events: DataFrame | None = None, frames: bool = True, **options) -> DataFrame:
    """Readings to the 25 feature columns (without ``frames``, those not in ``FRAMES``); options as for ``feature_rows``."""
    rows = feature_rows(readings, events, frames=frames, **options)
    return rows.select(*[c for c in COLUMNS if frames or c not in FRAMES])
