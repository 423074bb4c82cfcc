"""Commands over a warehouse: ``python -m millrace run|stream|export|status|summary|tidy --warehouse <path>``."""

from __future__ import annotations

import argparse
import sys

from millrace.functions.text import json_records
from millrace.operators.analytics import summarize_all
from millrace.plans import ledger
from millrace.plans.export import export_all, export_csv
from millrace.plans.runner import run_group
from millrace.plans.spec import load_yaml
from millrace.plans.warehouse import Warehouse
from millrace.session import build_session
from millrace.streaming.ingest import stream_sources


def _show(title: str, df, as_json: bool) -> None:
    """Ledger queries are limited to a few rows, so they can be printed."""
    print(f"== {title}")
    if as_json:
        for row in json_records(df).collect():
            print(row["record"])
    else:
        df.show(truncate=False)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="millrace")
    parser.add_argument("command", choices=("run", "stream", "export", "status", "summary", "tidy"))
    parser.add_argument("--warehouse", required=True, help="root folder of the tables")
    parser.add_argument("--config", help="YAML with groups of sources")
    parser.add_argument("--dq", help="YAML with quality rules")
    parser.add_argument("--group", default="daily")
    parser.add_argument("--fail-fast", action="store_true")
    parser.add_argument("--n", type=int, default=10, help="runs to show, or groups per summary")
    parser.add_argument("--last", action="store_true", help="also show the last load of each table")
    parser.add_argument("--json", action="store_true")
    parser.add_argument("--out", help="folder for summaries as CSV")
    parser.add_argument("--checkpoint", help="folder of the streams' checkpoints")
    parser.add_argument("--once", action="store_true", help="stream what is there, then end")
    parser.add_argument("--most-batches", type=int, default=100, help="tidy rewrites tables of more batches as one")
    args = parser.parse_args(argv)

    spark = build_session(f"millrace {args.command}")
    wh = Warehouse(spark, args.warehouse)
    if args.command in ("run", "stream", "export") and not args.config:
        parser.error(f"{args.command} needs --config")
    if args.command == "stream" and not args.checkpoint:
        parser.error("stream needs --checkpoint")
    if args.command == "run":
        rules = load_yaml(args.dq) if args.dq else None
        result = run_group(spark, wh, load_yaml(args.config), rules, args.group, args.fail_fast)
        for r in result.results:
            print(f"{r.source.name} -> {r.source.table}: {r.rows} rows, {r.decision}" + (f", error: {r.error}" if r.error else ""))
        return 0 if result.status == "ok" else 1
    if args.command == "stream":
        config = load_yaml(args.config)
        sources = [{**(config.get("defaults") or {}), **s} for s in (config.get("groups") or {}).get(args.group) or []]
        rules = load_yaml(args.dq) if args.dq else None
        for query in stream_sources(wh, sources, args.checkpoint, None if args.once else 60, rules).values():
            query.awaitTermination()
    elif args.command == "tidy":
        # No load may run meanwhile, nor a reader of what others have taken the place of.
        for name in wh.tables():
            if len(wh.batches(name)) > args.most_batches:
                wh.compact(name)
            print(f"{name}: {wh.vacuum(name)} batches removed")
        print(f"{wh.sweep()} unfinished batches removed")
    elif args.command == "export":
        for table, directory in export_all(wh, load_yaml(args.config)).items():
            print(f"{table} -> {directory}")
    elif args.command == "status":
        _show("recent runs", ledger.recent_runs(ledger.runs(wh), args.n), args.json)
        _show("recent metrics", ledger.recent_metrics(ledger.metrics(wh), args.n), args.json)
        if args.last:
            _show("last loads", ledger.last_loads(ledger.metrics(wh)), args.json)
    else:
        for name, df in summarize_all({t: wh.table(t) for t in wh.tables()}, args.n).items():
            _show(name, df, args.json)
            if args.out:
                export_csv(df, f"{args.out.rstrip('/')}/{name}_top")
    return 0


if __name__ == "__main__":
    sys.exit(main())
