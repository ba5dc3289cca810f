"""Run a registered query from the command line.

    python -m relayplan list
    python -m relayplan run <query> --data <dir> [--out <path>] [--show N]
    python -m relayplan explain <query> --data <dir>

``run`` writes parquet to ``--out`` (or shows rows); on a cluster submit the
same module with the platform's launcher so the session comes from it.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="relayplan")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        s = sub.add_parser(name)
        s.add_argument("query")
        s.add_argument("--data", required=True, help="folder with the input tables")
        s.add_argument("--master", default=None, help="e.g. local[8]; omit on a cluster")
        if name == "run":
            s.add_argument("--out", help="write the result as parquet here")
            s.add_argument("--show", type=int, default=20, help="rows to show when --out is not given")
    a = p.parse_args(argv)

    from relayplan import plans
    if a.cmd == "list":
        for q in sorted(plans.QUERIES):
            print(q if q in plans.ORACLES else f"{q} (no SQL twin)")
        return 0
    if a.query not in plans.QUERIES:
        print(f"unknown query {a.query!r}; see `python -m relayplan list`", file=sys.stderr)
        return 2

    from relayplan.session import build_session
    spark = build_session(a.master)
    df = plans.QUERIES[a.query](spark, a.data)
    if a.cmd == "explain":
        df.explain("formatted")
    elif a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.show, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
