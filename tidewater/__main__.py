"""Command line over the runner: the job-level workflow.

    python -m tidewater land   --root R --source S [--new .2 --header-only .3 --adjustment .35 --reversal .15]
                               [--touched 1.0 --buckets 20 --hot 0.8]
    python -m tidewater step   --root R [--tables claim,claim_detail] [--no-twin]
    python -m tidewater compact --root R [--threshold 0.2] [--force]
    python -m tidewater gold   --root R [--calendar 2023-01-01:2027-12-31]
    python -m tidewater skew   --root R --source S [--hot 0.8]
    python -m tidewater status --root R

``land`` lands the run after the one recorded in the control row (the seed
first), ``step`` runs bronze -> silver -> twin on what has landed, ``compact``
folds state into snapshots where the change ratio calls for it, ``gold``
publishes a new version of every gold dataset. The session is the cluster's
(``getOrCreate``); ``--local N`` starts a local one.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import changes as ch
from .plans import roles, skew
from .sources.control import read_control
from .streaming.runner import Runner


def _session(args) -> SparkSession:
    if args.local:
        from .session import local_session

        return local_session(args.local, max(8, 2 * int(args.local)))
    return SparkSession.builder.getOrCreate()


def _role_map(args) -> roles.RoleMap:
    mix = ch.ChangeMix(args.new, args.header_only, args.adjustment, args.reversal)
    return roles.RoleMap(mix=mix, n_buckets=args.buckets, touched=args.touched, hot_share=args.hot, hashed_buckets=args.buckets != 20)


def main(argv=None, spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="python -m tidewater")
    p.add_argument("command", choices=["land", "step", "compact", "gold", "skew", "status"])
    p.add_argument("--root", required=True, help="work folder (shared storage on a cluster)")
    p.add_argument("--source", help="folder of the source tables (orders, lineitem, ...)")
    p.add_argument("--tables", default="", help="comma-separated registry tables (default: all)")
    p.add_argument("--new", type=float, default=0.20)
    p.add_argument("--header-only", type=float, default=0.30)
    p.add_argument("--adjustment", type=float, default=0.35)
    p.add_argument("--reversal", type=float, default=0.15)
    p.add_argument("--touched", type=float, default=1.0)
    p.add_argument("--buckets", type=int, default=20)
    p.add_argument("--hot", type=float, default=0.0)
    p.add_argument("--no-twin", action="store_true")
    p.add_argument("--threshold", type=float, default=None)
    p.add_argument("--force", action="store_true")
    p.add_argument("--calendar", default="", help="start:end of dim_date (default: years of the service dates)")
    p.add_argument("--local", default="", help="run on local[N] instead of the cluster session")
    args = p.parse_args(argv)

    spark = spark or _session(args)
    runner = Runner(spark, args.root)
    tables = [t for t in args.tables.split(",") if t] or None
    out: dict = {"command": args.command}
    if args.command == "land":
        if not args.source:
            p.error("land needs --source")
        out["run"] = runner.land_next_run(args.source, _role_map(args), tables)
    elif args.command == "step":
        runner.step(tables, with_twin=not args.no_twin)
    elif args.command == "compact":
        if args.force:
            out["snapshots"] = runner.compact(tables)
        else:
            out["strategy"] = runner.maybe_compact(tables, args.threshold)
    elif args.command == "gold":
        out["version"] = runner.publish_gold(tuple(args.calendar.split(":")) if args.calendar else None)
    elif args.command == "skew":
        if not args.source:
            p.error("skew needs --source")
        inc = roles.changes(spark, args.source, "claim_detail", roles.INCREMENT, _role_map(args))
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        out["profile"] = {
            k: {
                "keys": skew.key_profile(inc, [k]).first().asDict(),
                "partitions": skew.partition_profile(inc, [k], n).first().asDict(),
            }
            for k in ("claim_detail_id", "provider_id")
        }
    elif args.command == "status":
        c = read_control(spark, args.root)
        out["control"] = None if c is None else {k: str(v) for k, v in c.asDict().items()}
        from .streaming import apply as ap

        out["live_rows"] = {
            t: runner.current(t).agg(F.count(F.lit(1))).first()[0]
            for t in runner.registry
            if ap.batch_ids(spark, runner.root, t)
        }
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
