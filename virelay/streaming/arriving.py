"""Annotation of genes that arrive as files.

All context features belong to one contig, and a contig arrives whole in a file,
so each micro-batch is annotated as a table of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import context


def arriving_genes(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Gene tables (Parquet) as they are put into ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def window_means_of(stream: DataFrame, output: str, checkpoint: str, columns: list[str], window: int, min_valid_pct: float,
                    contig: tuple[str, ...] = context.CONTIG, then: Callable[[DataFrame], DataFrame] = lambda df: df, available_now: bool = True) -> StreamingQuery:
    """Writes each batch's window means to ``output``, a folder for each batch.

    A batch that is run again after a failure replaces its own folder, so every
    gene is written once.
    """

    def written(batch: DataFrame, number: int) -> None:
        out = then(context.window_means(batch, columns, window, min_valid_pct, contig))
        out.write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = stream.writeStream.foreachBatch(written).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
