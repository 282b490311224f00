"""What the operators of this subpackage share: sessions, tables, word splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts travel to Python in batches of at most so many rows and bytes, so that a batch of long
# texts fits beside the others in an executor.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepared(spark: SparkSession) -> SparkSession:
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Rows of a few numbers that may be broadcast; larger tables are joined by a shuffle.
BROADCAST_ROWS = 400_000


def small_side(stored: DataFrame, rows: int | None = None) -> DataFrame:
    """A stored table, to be broadcast if it has few rows, so that texts need not move to meet it."""
    count = stored.count() if rows is None else rows
    return F.broadcast(stored) if count <= BROADCAST_ROWS else stored


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, a null text as the empty one; other columns stay behind."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. `lower` is the faster way where a text holds nothing but ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
