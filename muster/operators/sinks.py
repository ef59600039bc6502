"""Writing layers, deliverables and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_layer(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Parquet layer, replaced as a whole."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, per: str | None = None) -> None:
    """CSV deliverable with a header; ``per`` gives every value of a column its own folder.

    The rows are not gathered by that column first, so that one large group is still written by
    many tasks.
    """
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    (writer.partitionBy(per) if per else writer).csv(path)
