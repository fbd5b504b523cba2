"""Run one registered job: ``python -m layerkit <job> [sf_dir] [--show N | --out PATH]``.

``python -m layerkit --list`` prints the job names.
"""
from __future__ import annotations

import argparse
import os

from .plans.registry import NAMES, jobs
from .session import build_session


def main() -> None:
    ap = argparse.ArgumentParser(prog="layerkit")
    ap.add_argument("job", nargs="?")
    ap.add_argument("sf_dir", nargs="?", default=os.environ.get("SF_DIR", "/root/testdata/sf0.01"))
    ap.add_argument("--list", action="store_true")
    ap.add_argument("--show", type=int, default=20, help="preview rows (show(n))")
    ap.add_argument("--out", help="write the result as parquet instead of showing it")
    ap.add_argument("--master", default=os.environ.get("SPARK_MASTER"))
    args = ap.parse_args()
    if args.list or not args.job:
        print("\n".join(NAMES))
        return
    spark = build_session(args.master) if args.master else build_session()
    df = jobs()[args.job](spark, args.sf_dir)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=60)


if __name__ == "__main__":
    main()
