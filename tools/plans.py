"""Write PLANS.md: condensed physical plans of the headline queries.

Usage: python tools/plans.py [sf_dir]
Each plan is Spark's own ``explain()`` output, with expressions cut short so
the operator tree (exchanges, aggregates, joins, scans) stays readable.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater import queries as Q  # noqa: E402
from tidewater.plans import roles  # noqa: E402
from tidewater.session import local_session, work_dir  # noqa: E402
from tidewater.streaming.runner import Runner  # noqa: E402

NAMES = ["cdc_scd1_lines", "fact_header", "agg_daily", "snapshot_diff"]
WIDTH = 150


def condensed(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    lines = []
    for ln in buf.getvalue().splitlines():
        ln = re.sub(r"#\d+L?", "", ln)
        lines.append(ln if len(ln) <= WIDTH else ln[: WIDTH - 3] + "...")
    return "\n".join(lines)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    out = [
        "# Physical plans",
        "",
        f"Generated by `tools/plans.py` on `{sf_dir}` (local[8], 16 shuffle partitions, AQE on;",
        "plans shown before adaptive re-optimisation). Expressions are cut at",
        f"{WIDTH} characters.",
        "",
    ]
    for name in NAMES:
        out += [f"## {name}", "", "```", condensed(Q.REGISTRY[name](spark, sf_dir)), "```", ""]
    # The production read path: snapshot + a later batch, merged on read.
    r = Runner(spark, work_dir(spark, "plans"))
    r.land_roles(sf_dir, roles.SEED, tables=("claim_detail",))
    r.step(("claim_detail",), with_twin=False)
    r.compact(("claim_detail",))
    r.land_roles(sf_dir, roles.INCREMENT, tables=("claim_detail",))
    r.step(("claim_detail",), with_twin=False)
    out += [
        "## current state of claim_detail: snapshot merged with a later batch",
        "",
        "```",
        condensed(r.current("claim_detail")),
        "```",
        "",
    ]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
