"""python -m tidewell: init, sources, status, run, export, version."""

from __future__ import annotations

import argparse
import os
import sys
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tidewell.operators.catalog import Catalog
from tidewell.operators.export import export_rows, json_lines, stream_json_lines
from tidewell.operators.options import time_flag
from tidewell.operators.runs import SOURCES, run, status
from tidewell.sources import collectors

VERSION = "0.1"
assert collectors  # registers the sources


def config(path: str | None) -> dict[str, Any]:
    """A YAML file with $NAME of the environment filled in; {} without one.  Its sections under sources are their options."""
    if not path:
        return {}
    import yaml

    with open(path) as f:
        return yaml.safe_load(os.path.expandvars(f.read())) or {}


def enabled(options: Any) -> bool:
    """A section without `enabled` counts as enabled; a value that isn't a boolean doesn't."""
    return (options or {}).get("enabled", True) is True


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewell", description=__doc__)
    p.add_argument("--store", default="tidewell-store", help="folder of the tables")
    p.add_argument("--config", help="YAML file with options of the sources")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("init", "sources", "status", "version"):
        sub.add_parser(name)
    r = sub.add_parser("run")
    r.add_argument("sources", nargs="+", help="names, or all")
    r.add_argument("--max-records", type=int, default=0)
    r.add_argument("--since", help="so long ago (36h), RFC 3339, date and time, or date")
    r.add_argument("--until")
    r.add_argument("--no-resume", action="store_true")
    r.add_argument("--reset", action="store_true", help="forget the saved state first; rows stay")
    e = sub.add_parser("export")
    what = e.add_mutually_exclusive_group(required=True)
    what.add_argument("--query")
    what.add_argument("--table")
    e.add_argument("--where")
    e.add_argument("--order-by")
    e.add_argument("--limit", type=int)
    e.add_argument("--output", default="-")
    e.add_argument("--json-columns", default="")
    e.add_argument("--detect-json", action="store_true")
    e.add_argument("--progress", type=int, default=0)
    return p


def run_sources(store: Catalog, args: argparse.Namespace, sections: dict[str, Any]) -> int:
    names = [n for n in sections if enabled(sections[n])] if args.sources == ["all"] else args.sources
    if unknown := sorted(set(names) - set(SOURCES)):
        print(f"unknown sources: {', '.join(unknown)}", file=sys.stderr)
        return 2
    try:
        for k in ("since", "until"):
            time_flag(getattr(args, k))
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    failed = False
    for name in names:
        if args.reset:
            store.clear_state(name)
        options = {**(sections.get(name) or {}), **{k: v for k in ("since", "until") if (v := getattr(args, k))}}
        row = run(store, name, options, args.max_records, not args.no_resume)
        failed |= row["status"] == "failed"
        print(f"{name}: {row['status']}, {row['records']:,} rows, {row['duplicates']:,} duplicates, {row['errors']:,} errors")
        if row["status"] == "cancelled":  # no other source starts
            return 130
    return 1 if failed else 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    sections = config(args.config).get("sources") or {}
    if args.command == "version":
        print(VERSION)
        return 0
    if args.command == "sources":
        for name, (_, about) in sorted(SOURCES.items()):
            print(f"{name}\t{'enabled' if enabled(sections.get(name)) else 'disabled'}\t{about}")
        return 0
    spark = SparkSession.builder.appName("tidewell").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    store = Catalog(spark, args.store)
    if args.command == "init":
        print(f"{store.init()} migrations applied")
    elif args.command == "status":
        for r in status(store).toLocalIterator():
            print(f"{r.source}\trun {r.id}\t{r.status}\t{r.records:,} rows\t{r.state}")
    elif args.command == "run":
        return run_sources(store, args, sections)
    else:
        store.register()
        try:
            rows = export_rows(spark, args.query, args.table, args.where, args.order_by, args.limit)
            stream_json_lines(json_lines(rows, [c for c in args.json_columns.split(",") if c], args.detect_json), args.output, args.progress)
        except (ValueError, AnalysisException) as e:
            print(e, file=sys.stderr)
            return 2
        except BrokenPipeError:
            return 1
    return 0


if __name__ == "__main__":
    try:
        sys.exit(main())
    except KeyboardInterrupt:
        sys.exit(130)
