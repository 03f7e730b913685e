"""Link export as JSON records and as plain URL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_json(links: DataFrame, path: str) -> None:
    """One JSON object per line with the keys URL, Title and ID."""
    links.select(F.col("url").alias("URL"), F.col("title").alias("Title"), F.col("id").alias("ID")).write.json(path)


def export_urls(links: DataFrame, path: str) -> None:
    """One URL per line."""
    links.select("url").write.text(path)
