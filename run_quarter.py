"""Run one quarter over tables in a folder: spark-submit run_quarter.py --tables DIR ..."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from doseline.plans.quarter import Options, run_and_publish, run_quarter
from doseline.session import Stages, configure
from doseline.sources.tables import read_tables


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", required=True, help="folder holding one parquet table each")
    parser.add_argument("--calc-date", required=True, type=date.fromisoformat)
    parser.add_argument("--as-of", type=date.fromisoformat)
    parser.add_argument("--stages", help="shared folder for intermediate tables; _stages under the tables unless given")
    parser.add_argument("--publish", action="store_true", help="write the history tables")
    args = parser.parse_args()

    spark = configure(SparkSession.builder.appName("doseline-quarter").getOrCreate())
    options = Options(as_of=args.as_of)
    stages = Stages(spark, args.stages or f"{args.tables.rstrip('/')}/_stages")
    if args.publish:  # also finishes a run that died
        result = run_and_publish(spark, args.tables, args.calc_date, options, stages)
    else:
        result = run_quarter(spark, read_tables(spark, args.tables), args.calc_date, options, stages.keep)
    result["levels"].orderBy("strat_level").show()
    spark.stop()


if __name__ == "__main__":
    main()
