"""``spark-submit``-able entry: a full run from a config file."""

from __future__ import annotations

import argparse
import datetime as dt

from claimloom.plans.refresh import run_pipeline
from claimloom.session import build_session
from claimloom.sources.config import load_config


def main() -> None:
    parser = argparse.ArgumentParser(prog="claimloom")
    parser.add_argument("--config", default="config/claims.json")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="day ages are taken on")
    parser.add_argument("--resume", action="store_true", help="take tables that are finished as they are")
    args = parser.parse_args()
    spark = build_session("claimloom")
    run_pipeline(spark, load_config(args.config), as_of=args.as_of, resume=args.resume).show()
    spark.stop()


if __name__ == "__main__":
    main()
