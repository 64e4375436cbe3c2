"""Command line: all phases, or those from a given one on.

python -m stayline <folder of phase tables> --raw <folder of raw tables> [--format csv] [--phase 3]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stayline.config import Settings
from stayline.plans.pipeline import Pipeline
from stayline.sources.store import load_raw


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="stayline", description="Run the retention pipeline.")
    parser.add_argument("folder", help="where phase tables and exports are stored")
    parser.add_argument("--raw", help="raw tables; needed for phase 1")
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv", help="of the raw tables")
    parser.add_argument("--phase", type=int, choices=range(1, 8), default=1, help="phase to start with")
    given = parser.parse_args(arguments)
    if given.phase == 1 and not given.raw:
        parser.error("phase 1 needs --raw")
    spark = SparkSession.builder.appName("stayline").getOrCreate()
    raw = load_raw(spark, given.raw, given.format) if given.phase == 1 else None
    Pipeline(spark, Settings(), given.folder).run(raw, start_phase=given.phase)


if __name__ == "__main__":
    main()
