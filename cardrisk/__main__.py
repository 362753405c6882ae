"""Command line for the jobs: ``python -m cardrisk <command> ...`` locally, or
``spark-submit --py-files cardrisk.zip jobs/run.py <command> ...`` on a
cluster (only the driver imports the package; no code of it runs on the
executors).

Commands
  generate  --profile p2|p3|demo --rows N --out PATH       raw drop (JSON Lines; P2 as Parquet)
  ingest    --raw PATH --root PATH                          Bronze (+ quarantine partition)
  run       --raw PATH --root PATH [--tables]               Bronze -> Silver -> Gold
  batch     --raw PATH --root PATH --batch-id N [--tables]  one increment through all layers
  stream    --raw DIR --root PATH --checkpoint PATH         new files since the last run
  report    NAME [--root PATH] [--silver T --gold T] [--as-of D]   one of the six SQL reports
  erase     --root PATH --users ID [ID ...]                 remove users from every layer, for good
"""

from __future__ import annotations

import argparse
import json
import sys

from .operators import generate as gen
from .plans.pipeline import PipelineConfig, erase_subjects, ingest, run_batch, run_pipeline
from .plans.sql_reports import REPORTS, run_report
from .session import get_spark_session
from .sinks.writers import write_json_lines, write_layer

PROFILES = {"p2": gen.P2Profile, "p3": gen.P3Profile, "demo": gen.DemoProfile}
TABLES = {"silver": "silver_transactions", "gold": "gold_risk_profile"}


def _config(args) -> PipelineConfig:
    return PipelineConfig(raw_path=getattr(args, "raw", "") or "", root=args.root,
                          fmt=args.format, tables=TABLES if getattr(args, "tables", False) else {})


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cardrisk",
                                description="Run the cardrisk layer, report and maintenance jobs.")
    p.add_argument("--format", default="parquet", help="table format of the layers")
    sub = p.add_subparsers(dest="command", required=True)

    g = sub.add_parser("generate")
    g.add_argument("--profile", choices=sorted(PROFILES), default="p3")
    g.add_argument("--rows", type=int, required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--records-per-file", type=int, default=50_000)

    for name in ("ingest", "run", "batch"):
        c = sub.add_parser(name)
        c.add_argument("--raw", required=True)
        c.add_argument("--root", required=True)
        c.add_argument("--tables", action="store_true", help="register catalog tables")
        if name == "batch":
            c.add_argument("--batch-id", type=int, required=True)

    s = sub.add_parser("stream")
    s.add_argument("--raw", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--tables", action="store_true")

    r = sub.add_parser("report")
    r.add_argument("name", choices=sorted(REPORTS))
    r.add_argument("--root", default=None,
                   help="register Silver and Gold under ROOT first (a new application "
                        "starts with an empty session catalog)")
    r.add_argument("--silver", default=TABLES["silver"])
    r.add_argument("--gold", default=TABLES["gold"])
    r.add_argument("--as-of", default=None)
    r.add_argument("--rows", type=int, default=20, help="rows to print")
    r.add_argument("--out", help="write every row of the report here as Parquet")

    e = sub.add_parser("erase")
    e.add_argument("--root", required=True)
    e.add_argument("--users", nargs="+", required=True)
    e.add_argument("--tables", action="store_true")
    return p


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = parser().parse_args(argv)
    spark = spark or get_spark_session(f"cardrisk-{args.command}")
    out: dict = {"command": args.command}
    if args.command == "generate":
        df = gen.generate(spark, PROFILES[args.profile](), args.rows)
        if args.profile == "p2":
            write_layer(df, args.out, fmt=args.format)
        else:
            write_json_lines(df, args.out, args.records_per_file,
                             timestamp_format="yyyy-MM-dd'T'HH:mm:ss")
        out["rows"] = args.rows
    elif args.command == "ingest":
        cfg = _config(args)
        out["rows"] = ingest(spark, cfg).rows
        out["bronze"] = cfg.path("bronze")
    elif args.command == "run":
        out.update(run_pipeline(spark, _config(args)))
    elif args.command == "batch":
        out.update(run_batch(spark, _config(args), args.raw, args.batch_id))
    elif args.command == "stream":
        from .streaming.filedrop import run_stream_pipeline
        out["batches"] = run_stream_pipeline(spark, _config(args), args.raw, args.checkpoint)
    elif args.command == "report":
        if args.root:
            from .schemas import DATE_COL
            from .sources.readers import register_table
            cfg = PipelineConfig(raw_path="", root=args.root, fmt=args.format)
            for layer, name in (("silver", args.silver), ("gold", args.gold)):
                register_table(spark, name, cfg.path(layer), args.format, [DATE_COL])
        rows = run_report(spark, args.name, args.silver, args.gold, args.as_of)
        if args.out:  # the whole report; the console shows --rows of it
            rows.write.mode("overwrite").parquet(args.out)
            out["written"], rows = args.out, spark.read.parquet(args.out)
        out["rows"] = [r.asDict() for r in rows.limit(args.rows).collect()]
        out["rows_shown_at_most"] = args.rows
    elif args.command == "erase":
        user_type = "string"
        users = args.users
        if all(u.lstrip("-").isdigit() for u in users):
            users, user_type = [int(u) for u in users], "bigint"
        subjects = spark.createDataFrame([(u,) for u in users], f"user_id {user_type}")
        out.update(erase_subjects(spark, _config(args), subjects))
    return out


if __name__ == "__main__":
    print(json.dumps(main(sys.argv[1:]), default=str))
