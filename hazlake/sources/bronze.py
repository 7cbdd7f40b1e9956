"""Landed JSON lines: ``<raw>/<source>/<date>.jsonl`` or ``<raw>/[batch=<b>/]source=<s>/date=<d>/``."""

from __future__ import annotations

import logging
import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazlake.functions.once import once
from hazlake.schemas import BRONZE_LINE
from hazlake.session import path_exists

log = logging.getLogger(__name__)

_LINE_SCHEMA = "line string, source string, file_date string, file_path string"
_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# folder = source, file stem (or date= folder) = date
_FILE = r"/(?:source=)?([^/]+)/(?:date=([^/]+)/[^/]+|([^/]+?)\.jsonl?(?:\.[a-z0-9]+)?)$"


def read_lines(
    spark: SparkSession, raw_dir: str, source: str | None = None, date: str | None = None
) -> DataFrame:
    """Non-blank landed lines with the source and date their path names.

    A source and a date name the paths to list, so other folders are not even
    listed. A missing folder gives a warning and no rows.
    """
    if not path_exists(spark, raw_dir):
        log.warning("no such folder: %s", raw_dir)
        return spark.createDataFrame([], _LINE_SCHEMA)
    paths = _paths(spark, raw_dir, source, date)
    if not paths:
        return spark.createDataFrame([], _LINE_SCHEMA)
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*").text(paths)
    path = F.col("_metadata.file_path")
    named = text.select(
        F.btrim("value", F.lit(_SPACES)).alias("line"),
        F.regexp_extract(path, _FILE, 1).alias("source"),
        F.coalesce(
            F.nullif(F.regexp_extract(path, _FILE, 2), F.lit("")), F.regexp_extract(path, _FILE, 3)
        ).alias("file_date"),
        path.alias("file_path"),
    )
    return named.filter(F.col("line") != "")


def _paths(spark: SparkSession, raw_dir: str, source: str | None, date: str | None) -> list[str]:
    """What to read: the whole folder, or the existing paths a source and a date can lie under."""
    if source is None and date is None:
        return [raw_dir]
    # What no batch wrote lies in the first two; a date alone looks below any folder.
    named = "*" if source is None else f"source={_quoted(source)}"
    folders = [*dict.fromkeys(["*" if source is None else _quoted(source), named]), f"batch=*/{named}"]
    ends = [""] if date is None else [f"/date={_quoted(date)}", f"/{_quoted(date)}.json*"]
    found = []
    for pattern in (f"{raw_dir}/{folder}{end}" for folder in folders for end in ends):
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        matches = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
        found += [m.getPath().toString() for m in matches]
    return found


def _quoted(name: str) -> str:
    """A name with the characters that path patterns give a meaning quoted."""
    return re.sub(r"([*?\[\]{}\\,])", r"\\\1", name)


def parse_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Add ``shape`` and ``rec`` (typed fields).

    Shape goes by which keys an object has, even with a null value: ``weather``,
    ``media``, ``text``, or ``unknown``; null for a malformed line. ``from_json``
    alone forgives single quotes and trailing text, so a line counts as
    well-formed only if, put between brackets, it is valid strict JSON with
    exactly one element, an object.
    """
    boxed = F.try_parse_json(F.concat(F.lit("["), F.col(line_col), F.lit("]")))
    parsed = once(lines, {"_boxed": boxed, "rec": F.from_json(line_col, BRONZE_LINE)})
    one_object = (
        F.col(line_col).startswith("{")
        & F.col("_boxed").isNotNull()
        & F.try_variant_get("_boxed", "$[1]", "variant").isNull()
    )

    def has(key: str) -> Column:
        return F.try_variant_get("_boxed", f"$[0].{key}", "variant").isNotNull()

    shape = F.when(
        one_object,
        F.when(has("temperature_c") & has("location_name"), "weather")
        .when(has("source_url") & has("local_path"), "media")
        .when(has("source_type"), "text")
        .otherwise("unknown"),
    )
    shaped = once(parsed.select(*lines.columns, "_boxed", "rec"), {"shape": shape})
    return shaped.select(*lines.columns, "shape", "rec")


def malformed(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """The lines the loader skips."""
    return parse_lines(lines, line_col).filter(F.col("shape").isNull()).drop("shape", "rec")


def load_bronze(
    spark: SparkSession, raw_dir: str, source: str | None = None, date: str | None = None
) -> DataFrame:
    """Parsed lines of every chosen file; malformed lines have no shape."""
    return parse_lines(read_lines(spark, raw_dir, source, date))


def load_source_day(spark: SparkSession, raw_dir: str, source: str, date: str | None = None) -> DataFrame:
    """One source and day, today when none is named; a malformed line raises."""
    day = date or datetime.now(timezone.utc).strftime("%Y-%m-%d")
    parsed = load_bronze(spark, raw_dir, source, day)
    checked = F.when(F.col("shape").isNotNull(), F.col("rec")).otherwise(
        F.raise_error(F.concat(F.lit("malformed line in "), F.col("file_path"))).cast(BRONZE_LINE)
    )
    return parsed.select(checked.alias("rec")).select("rec.*")


def line_stats(lines: DataFrame) -> DataFrame:
    """Lines per source and date, with a total per source and a grand total (null keys)."""
    return lines.rollup("source", "file_date").agg(F.count("*").alias("records"))


def append_bronze(records: DataFrame, raw_dir: str, date: Column | None = None, batch: str | None = None) -> None:
    """Append records (with a ``source`` column) as JSON lines by source and save date.

    Every call writes below a root of its own, ``batch=<b>``, so writers at the same time share no
    folder that one could clear while another uses it. Writing a ``batch`` again replaces it whole,
    so a repeated batch of a stream leaves no row twice; without a name it is a new one.
    Null keys are written, because readers route on key presence. ``raw_payload``
    JSON text is written as an object again.
    """
    saved = F.date_format(F.current_date(), "yyyy-MM-dd") if date is None else date
    out = records.withColumn("date", saved)
    if "raw_payload" in records.columns:
        out = out.withColumn(
            "raw_payload", F.coalesce(F.try_parse_json("raw_payload"), F.parse_json(F.lit("{}")))
        )
    (
        out.hint("rebalance", F.col("source"), F.col("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("source", "date")
        .option("ignoreNullFields", "false")
        .json(f"{raw_dir}/batch={batch or uuid.uuid4().hex}")
    )
