"""Command line: ``python -m fairway.cli {ingest,metrics,extracts} ...``.

* ``ingest``   landed event list + payload documents -> rounds dataset (one folder per
               year and event) and a quarantine dataset; ``--stream`` runs the
               incremental Structured Streaming version (``availableNow``).
* ``metrics``  rounds dataset -> event difficulty CSV, course factor CSV, rolling
               index for all periods (Parquet, partitioned by period).
* ``extracts`` rolling index -> current standings and one player's trend (CSV).
"""

from __future__ import annotations

import argparse
import sys

from fairway.session import get_spark


def _ingest(spark, args) -> None:
    from fairway.operators.joins import materialize, run_scope
    from fairway.sources import ingest, io
    from fairway.streaming.landing import _exists, latest_rounds

    events = ingest.pga_events(ingest.read_event_list(spark, args.event_list))
    if args.stream:
        from fairway.streaming.landing import start_ingest

        query = start_ingest(spark, args.landing, events, args.rounds, args.quarantine,
                             args.checkpoint, multi_line=not args.json_lines, difficulty_root=args.difficulty,
                             index_root=args.index, periods=[int(p) for p in args.periods.split(",")])
        query.awaitTermination()
        return
    payloads = ingest.read_split_payloads(spark, args.landing) if args.split else ingest.read_payloads(
        spark, args.landing, multi_line=not args.json_lines)
    if _exists(spark, args.rounds):  # landed events are skipped
        payloads = ingest.unlanded_payloads(payloads, ingest.landed_event_keys(io.read_rounds(spark, args.rounds)))
    with run_scope():
        if args.strict:
            staged = ingest.rounds_from_payloads(payloads, events, strict=True)
            io.write_rounds(materialize(latest_rounds(staged.rounds), "rounds"), args.rounds)
            return
        # parsed once, then split
        result = ingest.split_rounds(materialize(ingest.staged_rounds(payloads, events), "staged"), stamped=True)
        io.write_rounds(latest_rounds(result.rounds), args.rounds)
        result.quarantine.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("year", "event_id").parquet(args.quarantine)


def _metrics(spark, args) -> None:
    from fairway.plans.pipeline import run_metrics

    run_metrics(spark, args.rounds, args.out, [int(p) for p in args.periods.split(",")])


def _extracts(spark, args) -> None:
    from fairway.plans.pipeline import run_extracts

    run_extracts(spark, args.out, period=args.period, year=args.year, max_days=args.max_days,
                 player=args.player)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fairway")
    sub = parser.add_subparsers(dest="command", required=True)

    ing = sub.add_parser("ingest", help="landed JSON -> rounds dataset")
    ing.add_argument("--event-list", required=True, help="landed event-list JSON file(s)")
    ing.add_argument("--landing", required=True, help="folder of payload documents")
    ing.add_argument("--rounds", required=True, help="rounds dataset root")
    ing.add_argument("--quarantine", required=True, help="quarantined rows root")
    ing.add_argument("--json-lines", action="store_true", help="documents are JSON Lines")
    ing.add_argument("--split", action="store_true", help="read each large JSON file by many tasks")
    ing.add_argument("--strict", action="store_true", help="fail on invalid rows")
    ing.add_argument("--stream", action="store_true", help="incremental streaming ingest")
    ing.add_argument("--checkpoint", help="stream checkpoint location (with --stream)")
    ing.add_argument("--difficulty", help="difficulty sums kept up to date there (with --stream)")
    ing.add_argument("--index", help="rolling index kept up to date there (with --difficulty)")
    ing.add_argument("--periods", default="25,50,75,100")
    ing.set_defaults(run=_ingest)

    met = sub.add_parser("metrics", help="rounds -> difficulty, course factor, rolling index")
    met.add_argument("--rounds", required=True)
    met.add_argument("--out", required=True)
    met.add_argument("--periods", default="25,50,75,100")
    met.set_defaults(run=_metrics)

    ext = sub.add_parser("extracts", help="current standings and a player's trend")
    ext.add_argument("--out", required=True)
    ext.add_argument("--period", type=int, default=50)
    ext.add_argument("--year", type=int, required=True)
    ext.add_argument("--max-days", type=int, default=730)
    ext.add_argument("--player", type=int, required=True)
    ext.set_defaults(run=_extracts)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    if args.command == "ingest" and args.stream and not args.checkpoint:
        raise SystemExit("--stream needs --checkpoint")
    spark = get_spark()
    args.run(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
