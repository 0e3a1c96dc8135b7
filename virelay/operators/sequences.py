"""Filters on contigs and their proteins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import contig_of


def long_enough(records: DataFrame, min_length: int) -> DataFrame:
    """Contigs of at least ``min_length`` bases, each judged alone."""
    return records.filter(F.length("seq") >= min_length)


def enough_genes(proteins: DataFrame, min_genes: int) -> DataFrame:
    """Proteins of contigs with at least ``min_genes`` of them in their file."""
    own = Window.partitionBy("source_file", "_contig")
    rows = proteins.withColumn("_contig", contig_of(F.col("name")))
    return rows.withColumn("_n", F.count(F.lit(1)).over(own)).filter(F.col("_n") >= min_genes).drop("_contig", "_n")


def totals(proteins: DataFrame) -> DataFrame:
    """n_genomes, n_contigs, n_proteins and n_residues."""
    return proteins.agg(
        F.countDistinct("genome").alias("n_genomes"), F.countDistinct(contig_of(F.col("name"))).alias("n_contigs"),
        F.count(F.lit(1)).alias("n_proteins"), F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("n_residues"),
    )


def unique_names(df: DataFrame, name: str, order: str) -> DataFrame:
    """Repeated names get ``_2``, ``_3`` and so on, in the order of ``order``."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return df.withColumn("_n", n).withColumn(name, F.when(F.col("_n") == 1, F.col(name)).otherwise(F.concat_ws("_", name, F.col("_n").cast("string")))).drop("_n")
