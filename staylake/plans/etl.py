"""End-to-end run: raw CSV folder -> cleaned stage -> star schema.

A plain function, one call per run; the run id is computed once here and
passed down.  Failures propagate (a failed load stops the modelling step).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from .. import schemas as S
from ..functions.dates import run_id
from ..sources.csv import read_csv_by_name, snapshot_csv
from ..sources.files import write_parquet
from .clean import CleanConfig, clean_listings
from .star import StarOptions, build_star, load_staging


@dataclass
class RunConfig:
    raw_dir: str
    out_dir: str                       # snapshots, stage and warehouse live below
    clean: CleanConfig = field(default_factory=CleanConfig)
    star: StarOptions = field(default_factory=StarOptions)
    now: _dt.datetime | None = None
    snapshots: bool = True             # CSV copies of the raw and the cleaned rows


def run_etl(spark: SparkSession, cfg: RunConfig) -> dict[str, int]:
    rid = run_id(cfg.now or _dt.datetime.now())
    base = cfg.out_dir.rstrip("/")
    # The CSV folder is parsed once into typed Parquet for this run; the raw
    # snapshot and the cleaning both read that columnar copy.
    raw_dir = write_parquet(read_csv_by_name(spark, cfg.raw_dir, S.LISTING_SCHEMA),
                            f"{base}/raw/run={rid}")
    raw = spark.read.parquet(raw_dir)
    # The cleaned rows are written once: the run's stage is what the star reads.
    staging = load_staging(clean_listings(raw, cfg.clean), f"{base}/staged/run={rid}")
    if cfg.snapshots:
        snapshot_csv(raw, f"{base}/raw_snapshot", rid)
        snapshot_csv(staging, f"{base}/staged_csv", rid)
    return build_star(staging, f"{base}/warehouse", cfg.star)
