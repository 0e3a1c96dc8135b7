"""Writers of tables and sequence files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .files import concatenated, exists, remove


def write_tsv(df: DataFrame, path: str, names: dict[str, str] | None = None, single_file: bool = True) -> None:
    """A tab-separated table with header; null as empty, booleans in lower case.

    ``names`` gives columns and their titles.  A ``single_file`` is put together
    from the parts that all tasks write, in the order of ``df``; otherwise the
    parts stay in a folder, each with a header.
    """
    out = df.select(*[F.col(c).alias(t) for c, t in names.items()]) if names else df
    to = f"{path}.parts" if single_file else path
    out.write.mode("overwrite").csv(to, sep="\t", header=not single_file, nullValue="", emptyValue="")
    if single_file:
        if exists(df.sparkSession, path):
            remove(df.sparkSession, path)
        concatenated(df.sparkSession, to, path, "\t".join(out.columns) + "\n")


def fasta_record(name: Column, description: Column, seq: Column) -> Column:
    """A record's text; no space follows a name without description."""
    return F.concat(F.lit(">"), name, F.when(F.coalesce(description, F.lit("")) != "", F.concat(F.lit(" "), description)).otherwise(F.lit("")), F.lit("\n"), seq)


def write_fasta(df: DataFrame, path: str, by: list[str] | None = None, name: str = "name", description: str = "description", seq: str = "seq", per_file: int = 1_000_000) -> None:
    """FASTA text, in a folder for each value of ``by``; every task writes its own files of ``per_file`` records at most."""
    out = df.select(*(by or []), fasta_record(F.col(name), F.col(description), F.col(seq)).alias("value"))
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", per_file)
    (writer.partitionBy(*by) if by else writer).text(path)


def write_category_files(df: DataFrame, folder: str, files: dict[tuple[str, str], str]) -> None:
    """The sequences of each (category, confidence) of ``files`` as one FASTA file below ``folder``; empty where there are none."""
    spark = df.sparkSession
    write_fasta(df, f"{folder}/.parts", by=["category", "confidence"])
    for (category, confidence), name in files.items():
        parts = f"{folder}/.parts/category={category}/confidence={confidence}"
        if not exists(spark, parts):
            df.sparkSession.createDataFrame([], "value string").write.mode("overwrite").text(parts)
        concatenated(spark, parts, f"{folder}/{name}")
    remove(spark, f"{folder}/.parts")
