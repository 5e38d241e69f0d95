"""Command line for spark-submit: ``python -m assaylake {load,vocabulary,build,check,day} ROOT ...``."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from assaylake.config import EngineConfig
from assaylake.plans import nightly
from assaylake.plans.build import adopt_stored
from assaylake.schemas.cdm import catalogue_from_ddl
from assaylake.session import configure
from assaylake.sinks.raw import load_run
from assaylake.sources.seeds import TEST_SEED, UNIT_SEED, seed_scan
from assaylake.sources.vocabulary import load_bundle
from assaylake.workspace import Workspace


def _locate(spark: SparkSession, folder: str):
    """Path of a vocabulary file in an extracted bundle, or None."""

    def locate(table: str) -> str | None:
        for path in (f"{folder}/{table.upper()}.csv", f"{folder}/{table}.csv"):
            try:
                spark.read.text(path)
                return path
            except AnalysisException:
                continue
        return None

    return locate


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="assaylake")
    parser.add_argument("command", choices=["load", "vocabulary", "build", "check", "day"])
    parser.add_argument("root", help="folder of the stored tables")
    parser.add_argument("--landing", help="landing prefix (load, day)")
    parser.add_argument("--run-date", help="YYYY-MM-DD (load, day)")
    parser.add_argument("--bundle", help="folder of extracted vocabulary files (vocabulary)")
    parser.add_argument("--full-refresh", action="store_true", help="rebuild measurement (build, day)")
    parser.add_argument("--days", nargs="*", help="run dates loaded since the last build; all if not given (build)")
    parser.add_argument("--test-seed", help="CSV of the site's test codes (build, check, day)")
    parser.add_argument("--unit-seed", help="CSV of the site's unit spellings (build, check, day)")
    parser.add_argument("--set", nargs="*", default=[], metavar="NAME=VALUE", help="settings of EngineConfig")
    parser.add_argument("--ddl", nargs="*", help="DDL files of the data model; its tables and keys are checked too (check)")
    parser.add_argument("--shred-raw", action="store_true", help="store raw documents shredded: smaller files, slower loads (all)")
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName("assaylake").getOrCreate(), args.shred_raw)
    config = configured(args.set)
    seeds = {}
    if args.test_seed:
        seeds["test"] = seed_scan(spark, args.test_seed, TEST_SEED)
    if args.unit_seed:
        seeds["unit"] = seed_scan(spark, args.unit_seed, UNIT_SEED)
    ws = Workspace.at(spark, args.root, config, **seeds)
    if args.command == "load":
        with nightly.recorded(ws, args.root, "parse"):
            load_run(spark, args.landing, args.run_date, f"{args.root}/raw").show()
    elif args.command == "vocabulary":
        stored, skipped = load_bundle(spark, _locate(spark, args.bundle), f"{args.root}/vocabulary")
        print(f"loaded {sorted(stored)}, not in the bundle: {skipped}")
    elif args.command == "build":
        with nightly.recorded(ws, args.root, "build"):
            nightly.build(ws, args.root, args.full_refresh, args.days)
    elif args.command == "check":
        adopt_stored(ws, f"{args.root}/staging", f"{args.root}/cdm")
        catalogue = catalogue_from_ddl(spark, *args.ddl) if args.ddl else None
        results = nightly.check_all(ws, catalogue).persist()
        nightly.record_stage(ws, args.root, "test", nightly.failing(results).isEmpty())
        nightly.verdicts(ws, nightly.completed_stages(ws, args.root)).show(truncate=False)
        return report(results)
    else:
        return report(nightly.run_day(spark, args.landing, args.root, args.run_date, config, args.full_refresh, **seeds))
    return 0


def configured(settings: list[str]) -> EngineConfig:
    """An ``EngineConfig`` from NAME=VALUE texts, cast to the types of the defaults."""
    values = {}
    for setting in settings:
        name, _, value = setting.partition("=")
        default = getattr(EngineConfig(), name)
        values[name] = value.lower() in ("1", "true", "yes") if isinstance(default, bool) else type(default)(value)
    return EngineConfig(**values)


def report(results: DataFrame) -> int:
    """Print all failures and their number; 1 if one must stop the chain."""
    failed = results.filter("failed > 0")
    for row in failed.orderBy("check", "table_name", "column_name").toLocalIterator():
        print(f"{row['check']} {row['table_name']}.{row['column_name']}: {row['failed']} of {row['total']}")
    print(f"{failed.count()} checks with failures")
    return int(not nightly.failing(results).isEmpty())


if __name__ == "__main__":
    sys.exit(main())
