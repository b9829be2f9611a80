"""Run the whole reference flow from the command line.

    python -m respengine --text PATH [--sep TAB] --out DIR
    python -m respengine --events SF_DIR --out DIR

Each result table is written to ``DIR/<name>`` as parquet and the metric
report is printed. On a cluster, submit with ``spark-submit -m respengine``
style wrappers; the session comes from the environment and its
``spark.checkpoint.dir`` is used for intermediate tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .lifetime import Lifetime
from .plans.report import reference_flow
from .plans.workflow import split_observations
from .session import ensure_checkpoint_dir
from .sources.tables import ctr_events
from .sources.text import read_labelled_lines


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="respengine")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--text", help="labelled delimited text file or folder")
    src.add_argument("--events", help="folder holding events.parquet")
    ap.add_argument("--sep", default="\t", help="field separator of --text (default tab)")
    ap.add_argument("--blank", default="drop", choices=["drop", "positive"])
    ap.add_argument("--out", required=True, help="output folder for the result tables")
    ap.add_argument("--ohe-iterations", type=int, default=50)
    ap.add_argument("--grid-iterations", type=int, default=500)
    ap.add_argument("--split-storage", default="table", choices=["cache", "table"])
    ap.add_argument("--ui", action="store_true", help="keep the Spark web UI on (off by default)")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("respengine")
    if not args.ui:
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    with Lifetime(spark):
        _run(spark, args)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    obs = (read_labelled_lines(spark, args.text, sep=args.sep, blank=args.blank) if args.text
           else ctr_events(spark, args.events))
    splits = split_observations(obs, storage=args.split_storage)
    tables = reference_flow(splits, ohe_iterations=args.ohe_iterations,
                            grid_iterations=args.grid_iterations)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
    tables["metric_report"].orderBy("features", "split", "model", "metric").show(
        50, truncate=False)


if __name__ == "__main__":
    main()
