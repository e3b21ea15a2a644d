"""Already fetched pages as a table (page id, url, raw html).

Fetching is not part of the library; extraction runs over a page table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_pages(spark: SparkSession, path: str, id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html") -> DataFrame:
    return spark.read.parquet(path).select(id_col, url_col, html_col)
