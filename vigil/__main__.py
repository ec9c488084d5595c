"""One monitoring run over a folder of snapshots:

    spark-submit --py-files vigil.zip vigil/__main__.py SNAPSHOTS HISTORY [options]
    python -m vigil SNAPSHOTS HISTORY [options]

Prints the run record as JSON; exits with 1 if the run has failed."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def main(argv: list | None = None) -> int:
    p = argparse.ArgumentParser(prog="vigil", description="check the newest snapshot of a folder")
    p.add_argument("snapshots", help="folder of snapshot files or partition folders")
    p.add_argument("history", help="path of the history table")
    p.add_argument("--model", help="path of the saved forest")
    p.add_argument("--dataset", default="ecommerce_sales")
    p.add_argument("--as-of", type=dt.date.fromisoformat, help="day that counts as today")
    a = p.parse_args(argv)

    from vigil.plans.pipeline import run_pipeline
    from vigil.session import get_session

    record = run_pipeline(get_session(), a.snapshots, a.history, a.model, dataset_name=a.dataset, as_of=a.as_of).first()
    print(json.dumps(record.asDict(), default=str))
    return int(record.status != "success")


if __name__ == "__main__":
    sys.exit(main())
