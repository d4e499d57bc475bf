"""Stages from the command line: tables of a folder in, tables of a run out.

python -m pagelode.plans.run --tables FOLDER --out FOLDER [--stage NAME | --until NAME] [--first-page N] [--last-page N]
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from pagelode.plans.pipeline import STAGES, Config, run_chain, run_stage
from pagelode.session import ship_package
from pagelode.sinks.files import StageRun, write_csv


def main(argv: list[str] | None = None) -> None:
    names = [n for n, _ in STAGES]
    p = argparse.ArgumentParser()
    p.add_argument("--tables", required=True, help="folder of <name>.parquet")
    p.add_argument("--out", required=True)
    p.add_argument("--stage", choices=names)
    p.add_argument("--until", choices=names)
    p.add_argument("--first-page", type=int)
    p.add_argument("--last-page", type=int)
    p.add_argument("--stitch", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    ship_package(spark)
    run = StageRun.create(a.stage or "chain")
    cfg = Config(run_id=run.stage_run_id, first_page=a.first_page, last_page=a.last_page, stitch=a.stitch)
    given = {f.removesuffix(".parquet"): spark.read.parquet(f"{a.tables}/{f}") for f in sorted(os.listdir(a.tables)) if f.endswith(".parquet")}
    out = run_stage(a.stage, given, cfg) if a.stage else run_chain(given, cfg, a.until)
    for name, df in out.items():
        if given.get(name) is not df:
            df.write.mode("overwrite").parquet(run.path(a.out, f"{name}.parquet"))
    if "test_cases" in out:
        write_csv([out["test_cases"]], run.path(a.out, "test_cases.csv")).write.mode("overwrite").json(run.path(a.out, "coverage_report.json"))
    run.manifest(spark).write.mode("overwrite").json(run.path(a.out, "run_manifest.json"))


if __name__ == "__main__":
    main()
