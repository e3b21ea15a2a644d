"""staylake: listing data -> validated, enriched star schema on Spark.

Subpackages
-----------
functions   Column expressions (text, dates)
sources     CSV/Parquet/page readers and writers, staging and tables
operators   data quality, metrics, extraction, reviews, keys, merges
plans       cleaning, staging and star-schema loading
streaming   incremental file loads
"""

from .session import get_spark, run_dir, work_dir  # noqa: F401
