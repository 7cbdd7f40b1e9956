"""``python -m hazlake <command>``: the lake's jobs on a cluster or on this machine."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from hazlake.operators.search import INDEXED, Match
from hazlake.plans.collect import collect, full_run
from hazlake.plans.lake import Lake
from hazlake.session import build_session
from hazlake.streaming.intake import start_intake

SEARCH_COLUMNS = ["source_type", "hazard_type", "hazard_severity", "location_name", "text"]
BBOX_COLUMNS = ["source_type", "location_name", "hazard_type", "hazard_severity", "lat", "lon"]


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="hazlake")
    parser.add_argument("--raw", default="data/raw", help="bronze folder")
    parser.add_argument("--lake", default="data/lake", help="lake folder")
    parser.add_argument("--landing", default="data/landing", help="landed API payloads")
    parser.add_argument("--master", default=None, help="Spark master, if spark-submit does not set it")
    parser.add_argument("--save", default=None, help="folder for whole results, one Parquet table per report")
    parser.add_argument("--limit", type=int, default=1000, dest="shown", help="rows shown on the terminal; says so if there are more")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple) -> None:
        sub = commands.add_parser(name)
        for flags, settings in options:
            sub.add_argument(flags, **settings)

    caps = [(f"--max-{what}", {"type": int}) for what in ("tweets", "posts")]
    date, start, end = ("--date", {}), ("--start", {}), ("--end", {})
    output = ("--output", {"required": True})
    fmt = ("--format", {"choices": ["parquet", "csv"], "default": "parquet"})
    days = ("--days", {"type": int, "default": 7})
    command("ingest", date, ("--source", {}))
    command("stats")
    command("query", ("sql", {}))
    command("db-stats")
    command("db-query", ("sql", {}))
    several = {"action": "append", "default": []}
    command(
        "search", ("query", {"nargs": "?", "default": ""}), ("--limit", {"type": int, "default": 20}),
        *[(f"--{k}", several) for k in ("phrase", "prefix", "any", "none")], ("--column", {"action": "append", "choices": INDEXED}),
    )
    command("bbox", *[(f"--{k}", {"type": float, "required": True}) for k in ("min-lat", "max-lat", "min-lon", "max-lon")])
    command("time-range", ("--start", {"required": True}), ("--end", {"required": True}), ("--source", {}), ("--hazard", {}))
    command(
        "export-ml", output, start, end, ("--hazard", {}), fmt,
        ("--train-ratio", {"type": float, "default": 0.8}), ("--val-ratio", {"type": float, "default": 0.1}),
    )
    command("export-sensors", output, start, end, fmt)
    command("migrate")
    command("validate")
    command("batch", days, ("--media", {}), *caps)
    command("collect", ("source", {}), days, ("--media", {}), *caps)
    command("stream", *[(f"--no-{s}", {"action": "store_true"}) for s in ("twitter", "reddit", "weather")], ("--checkpoint", {"required": True}))
    command("bronze-stats")
    command(
        "run", days, date, ("--media", {}), ("--collect-only", {"action": "store_true"}), ("--lake-only", {"action": "store_true"}),
        *caps,
    )
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(master=args.master)
    lake = Lake(spark, args.raw, args.lake)
    now = datetime.now(timezone.utc)
    name = args.command

    def report(title: str, df: DataFrame, width: int | bool = False) -> None:
        """Save a whole result if asked to; show its first rows."""
        if args.save:
            df.write.mode("overwrite").parquet(f"{args.save}/{title}")
        rows = df.limit(args.shown + 1)
        rows.limit(args.shown).show(args.shown, truncate=width)
        if rows.count() > args.shown:
            print(f"the first {args.shown} rows of {title}; --limit shows more, --save writes all")

    if name == "ingest":
        print(lake.run(args.date, args.source))
    elif name in ("stats", "db-stats"):
        first, second = (lake.stats, lake.hazard_summary) if name == "stats" else (lake.db_stats, lake.db_hazard_summary)
        report("stats", first())
        report("hazard_summary", second())
    elif name in ("query", "db-query"):
        report(name, (lake.query if name == "query" else lake.db_query)(args.sql))
    elif name == "search":
        match = Match(
            args.query, tuple(args.phrase), tuple(args.prefix), tuple(args.any), tuple(args.none), tuple(args.column or INDEXED),
        )
        plain = not (args.phrase or args.prefix or args.any or args.none or args.column)
        report("search", lake.search_text(args.query if plain else match, args.limit).select(*SEARCH_COLUMNS), 120)
    elif name == "bbox":
        box = lake.query_bbox(args.min_lat, args.max_lat, args.min_lon, args.max_lon)
        report("bbox", box.select(*BBOX_COLUMNS))
    elif name == "time-range":
        report("time_range", lake.query_time_range(args.start, args.end, args.source, args.hazard).select(*SEARCH_COLUMNS), 120)
    elif name == "export-ml":
        classes = [h.strip() for h in args.hazard.split(",")] if args.hazard else None
        out = lake.export_ml(
            args.output, classes, args.start, args.end, args.format, args.train_ratio, args.val_ratio
        )
        print(f"{out.count()} rows in {args.output}")
    elif name == "export-sensors":
        out = lake.export_sensor_features(args.output, args.start, args.end, args.format)
        print(f"{out.count()} rows in {args.output}")
    elif name == "migrate":
        print(lake.migrate())
        unread = lake.unread_files()
        if not unread.isEmpty():
            print("silver files not read, or not whole")
            report("unread_files", unread)
    elif name == "validate":
        for title, result in lake.validate().items():
            print(title)
            report(title, result)
    elif name in ("batch", "collect"):
        only = [{"news": "news_api"}.get(args.source, args.source)] if name == "collect" else None
        collect(
            spark, args.landing, args.raw, now, args.days, media_dir=args.media, only=only,
            max_tweets=args.max_tweets, max_posts=args.max_posts,
        ).show()
    elif name == "stream":
        chosen = tuple(s for s in ("twitter", "reddit", "weather") if not getattr(args, f"no_{s}"))
        start_intake(spark, args.landing, args.raw, args.checkpoint, chosen)
        # A source that fails ends the program, so that nobody takes a silent one for running.
        spark.streams.awaitAnyTermination()
    elif name == "bronze-stats":
        report("bronze_stats", lake.bronze_stats().orderBy("source", "file_date"))
    elif name == "run":
        done = full_run(
            lake, args.landing, now, args.days, args.collect_only, args.lake_only, args.date, media_dir=args.media,
            max_tweets=args.max_tweets, max_posts=args.max_posts,
        )
        for title, result in done.items():
            print(title)
            print(result) if isinstance(result, dict) else report(title, result)


if __name__ == "__main__":
    main()
