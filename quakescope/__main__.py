"""Command line: ``python -m quakescope {batch,ingest,dashboard,stream} ...``.

The session comes from ``spark-submit`` / the environment; ``--master`` is
only for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys

from quakescope.session import build_session


def _reader(spark, path: str, fmt: str):
    from quakescope.sources import catalog

    if fmt == "csv":
        return catalog.read_csv(spark, path)
    if fmt == "parquet":
        return catalog.read_parquet(spark, path)
    return catalog.read_json(spark, path)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quakescope")
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[*]")
    sub = ap.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("batch", help="clean, report, cluster; write Parquet + analytics_results.json")
    b.add_argument("input")
    b.add_argument("out")
    b.add_argument("--format", choices=["csv", "parquet", "json"], default="csv")
    b.add_argument("--k", type=int, default=6)
    b.add_argument("--top", type=int, default=200)

    i = sub.add_parser("ingest", help="catalogue CSV → event payloads → topic or JSON lines")
    i.add_argument("input")
    i.add_argument("--bootstrap-servers", default=None)
    i.add_argument("--out", default=None, help="JSON-lines folder when no broker is given")
    i.add_argument("--metrics", default=None, help="where to write the ingestion report (JSON)")

    d = sub.add_parser("dashboard", help="write every dashboard feed as Parquet")
    d.add_argument("input")
    d.add_argument("out")
    d.add_argument("--format", choices=["csv", "parquet", "json"], default="csv")
    d.add_argument("--no-zones", action="store_true")
    d.add_argument("--report", default=None, help="report bundle of the batch job")

    s = sub.add_parser("stream", help="clean the event feed into Parquet (drains what is there)")
    s.add_argument("out")
    s.add_argument("checkpoint")
    s.add_argument("--source", default=None, help="JSON-lines folder of payloads")
    s.add_argument("--bootstrap-servers", default=None)
    s.add_argument("--follow", action="store_true",
                   help="keep running on new input (10 s micro-batches) instead of draining")

    args = ap.parse_args(argv)
    spark = build_session("quakescope-" + args.cmd, master=args.master)
    if args.cmd == "batch":
        from quakescope.plans.batch import run_batch

        report = run_batch(spark, _reader(spark, args.input, args.format), args.out, k=args.k,
                           top_k=args.top)
        print(json.dumps(report["pipeline_metrics"], default=str))
    elif args.cmd == "ingest":
        from quakescope.plans.ingest import run_ingest

        print(json.dumps(run_ingest(spark, args.input, args.bootstrap_servers, args.out,
                                    metrics_path=args.metrics), default=str))
    elif args.cmd == "dashboard":
        from quakescope.plans.dashboard import run_dashboard

        paths = run_dashboard(spark, _reader(spark, args.input, args.format), args.out,
                              with_zones=not args.no_zones, report_path=args.report)
        print(json.dumps(paths))
    else:
        from quakescope.streaming.clean_stream import read_messages, start_clean_sink

        messages = read_messages(spark, args.source, args.bootstrap_servers)
        start_clean_sink(messages, args.out, args.checkpoint,
                         available_now=not args.follow).awaitTermination()
        print(json.dumps({"out": args.out}))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
