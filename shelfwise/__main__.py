"""Command line: ``spark-submit``-able build jobs and reports."""

from __future__ import annotations

import argparse
from contextlib import nullcontext

from pyspark.sql import SparkSession

from shelfwise.operators import quality
from shelfwise.operators.coherence import least_coherent
from shelfwise.plans import jobs
from shelfwise.session import drop_scratch, tune
from shelfwise.sinks.runlog import RunJournal, entries, latest_runs, unknown_entries
from shelfwise.sources.files import path_exists, read_csv_strings


_OPTIONAL = {"scan", "profiles", "analysis", "source", "state", "tags", "primary", "secondary", "countries"}
_HARVESTS = ("tags", "primary", "secondary", "countries", "fingerprints")
_CACHED = ("library", "tags", "primary", "secondary", "countries")


def _library_command(spark: SparkSession, args: argparse.Namespace):
    """Commands that read the library CSV and the harvest caches."""
    library = read_csv_strings(spark, args.library)
    tags, primary, secondary, countries = (jobs.load_cache(spark, n, getattr(args, n)) for n in _CACHED[1:])
    if args.command == "analyse":
        return jobs.build_analysis(library, tags, primary, secondary, countries, args.out)
    if args.command == "progress":
        return jobs.harvest_coverage(library, tags, primary, countries)
    rows, names = jobs.tagged_library(library, tags, primary, secondary), jobs.playlist_names(library)
    if args.command == "coherence":
        return least_coherent(jobs.report_coherence(rows, names, args.out))
    return jobs.report_split(rows, names, args.out)


def main() -> None:
    parser = argparse.ArgumentParser(prog="shelfwise", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str, flags: tuple[str, ...] = ()) -> None:
        sub = commands.add_parser(name)
        for argument in arguments:
            optional = argument in _OPTIONAL or (name == "music-build" and argument == "library")
            sub.add_argument(f"--{argument}", required=not optional)
        for flag in flags:
            sub.add_argument(f"--{flag}", action="store_true")

    command("music-build", "library", "scan", "profiles", "analysis", "out", flags=("stats",))
    command("places-build", "source", "out", "state", flags=("stats", "backfill"))
    command("places-inventory", "data")
    command("history", "exports", "out")
    command("dedup", "csv", "out")
    command("retag", "fingerprints", "csv", "out")
    for name in ("analyse", "coherence", "split"):
        command(name, *_CACHED, "out")
    command("progress", *_CACHED)
    pending = commands.add_parser("pending")
    pending.add_argument("--harvest", choices=_HARVESTS, required=True)
    pending.add_argument("--library", help="library CSV, or the file scan CSV for fingerprints", required=True)
    pending.add_argument("--cache", help="the harvest's cache")
    pending.add_argument("--out", required=True)
    pending.add_argument("--limit", type=int, default=0)
    pending.add_argument("--retry", action="store_true", help="ask for misses again")
    pending.add_argument("--exclude", action="append", default=[], help="part of a path to leave out")
    batches = commands.add_parser("batches")
    batches.add_argument("--library", required=True)
    batches.add_argument("--cache")
    batches.add_argument("--out", required=True)
    batches.add_argument("--used", type=int, default=0, help="requests already used")
    batches.add_argument("--retry", action="store_true")
    checked = commands.add_parser("quality")
    checked.add_argument("--tables", help="folder of the published tables", required=True)
    checked.add_argument("--rules", help="music, places, or a CSV of table, rule, condition, severity, guard, unique", required=True)
    commands.add_parser("runs")
    for sub in commands.choices.values():
        sub.add_argument("--journal", help="folder of the journal of runs")
    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"shelfwise {args.command}").getOrCreate()
    journal = nullcontext()
    if args.journal and args.command != "runs":
        journal = RunJournal(spark, args.journal, args.command, **{k: v for k, v in vars(args).items() if k not in ("command", "journal")})
    try:
        with journal:
            run(spark, args, parser, journal if args.journal else None)
    finally:
        drop_scratch(spark)


def _pending_command(spark: SparkSession, args: argparse.Namespace):
    """Write what a harvest has to ask for next; returns how much that is."""
    library = read_csv_strings(spark, args.library)
    if args.command == "batches":
        rows = jobs.pending_batches(library, jobs.load_cache(spark, "primary", args.cache), args.used, args.retry)
    elif args.harvest == "fingerprints":
        cache = jobs.load_cache(spark, "fingerprints", args.cache)
        rows = jobs.pending_files(library, cache, tuple(args.exclude), args.limit)
    else:
        rows = jobs.pending_keys(library, jobs.load_cache(spark, args.harvest, args.cache), args.harvest, args.limit, args.retry)
    rows.write.mode("overwrite").parquet(args.out)
    return spark.read.parquet(args.out).selectExpr("count(*) AS pending")


def _rules(spark: SparkSession, name: str) -> dict[str, list[quality.Rule]]:
    known = {"music": quality.MUSIC_RULES, "places": quality.PLACE_RULES}
    return known.get(name) or quality.read_rules(read_csv_strings(spark, name).collect())


def run(spark: SparkSession, args: argparse.Namespace, parser: argparse.ArgumentParser, journal: RunJournal | None = None) -> None:
    tune(spark)

    def optional_csv(path: str | None):
        return read_csv_strings(spark, path) if path and path_exists(spark, path) else None

    if args.command == "music-build":
        result = jobs.music_totals(spark, args.out) if args.stats else jobs.build_music(
            spark, args.out, *[optional_csv(p) for p in (args.library, args.scan, args.profiles, args.analysis)]
        )
    elif args.command == "places-build":
        if not args.stats and not (args.source and args.state):
            parser.error("places-build needs --source and --state, or --stats")
        result = jobs.places_totals(spark, args.out) if args.stats else jobs.build_places(
            spark, args.source, args.out, args.state, args.backfill
        )
    elif args.command == "places-inventory":
        for name, table in jobs.inventory(spark, args.data).items():
            print(name)
            table.show(truncate=False)
        return
    elif args.command == "history":
        result = jobs.report_history(spark, args.exports, args.out)
    elif args.command == "retag":
        cache = jobs.load_cache(spark, "fingerprints", args.fingerprints)
        result = jobs.report_retag(cache, read_csv_strings(spark, args.csv), args.out)
    elif args.command == "quality":
        jobs.check_tables(spark, args.tables, _rules(spark, args.rules), journal).show(1000, truncate=False)
        return
    elif args.command == "runs":
        if not args.journal:
            parser.error("runs needs --journal")
        print("entries of newer versions:", unknown_entries(spark, args.journal))
        result = latest_runs(entries(spark, args.journal))
    elif args.command in ("pending", "batches"):
        result = _pending_command(spark, args)
    elif args.command in ("analyse", "coherence", "split", "progress"):
        result = _library_command(tune(spark), args)
    else:
        result = jobs.report_duplicates(spark, args.csv, args.out)
    result.show(truncate=False, vertical=True)


if __name__ == "__main__":
    main()
