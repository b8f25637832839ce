"""JDBC sink. Rows go from the tasks to the database in parallel, never over the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: the driver class that a MySQL connection names in its properties.
MYSQL_DRIVER = "com.mysql.cj.jdbc.Driver"
MODES = ("overwrite", "append", "ignore", "error")


def export_jdbc(
    df: DataFrame,
    table: str,
    url: str,
    properties: dict[str, str],  # user, password and driver, such as MYSQL_DRIVER
    mode: str = "overwrite",
    connections: int = 16,
    batch_rows: int = 1000,
) -> None:
    """Writes a table with at most `connections` parallel connections."""
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    (
        df.write.mode(mode)
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .jdbc(url=url, table=table, properties=properties)
    )
