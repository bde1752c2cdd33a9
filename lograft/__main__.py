"""``python -m lograft <job> --opt key=value ...`` (see ``lograft.plans.jobs``)."""

from __future__ import annotations

import argparse

from lograft.plans.jobs import JOBS
from lograft.session import get_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="lograft")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--opt", action="append", default=[], metavar="KEY=VALUE")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    opts = dict(o.split("=", 1) for o in args.opt)
    spark = get_session(args.master, app=f"lograft-{args.job}")
    result = JOBS[args.job](spark, opts)
    if hasattr(result, "awaitTermination"):
        result.awaitTermination()


if __name__ == "__main__":
    main()
