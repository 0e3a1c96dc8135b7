"""FASTA sources: records straight from Spark's text reader, split at ``>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import contig_of, file_stem
from .files import exists

NUCLEOTIDE = ("fasta", "fa", "fna")
PROTEIN = ("fasta", "fa", "faa")


def read_fasta(spark: SparkSession, paths: str | list[str], is_vmag: bool = False, extensions: tuple[str, ...] | None = None) -> DataFrame:
    """The records of FASTA files: source_file, is_vmag, genome, name, description, seq.

    Files are split by record, not by line, so a file is read in parallel.  Line
    ends of any kind, lines of any length, a ``*`` stop and lower case are kept
    out of ``seq`` as the format has them: line breaks go, letters stay.  A
    record without sequence has an empty one.  The genome is the file's stem for
    ``is_vmag`` files, else the record's name.  ``extensions`` filters a folder.
    """
    reader = spark.read.option("lineSep", "\n>")
    if extensions:
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(extensions) + "}")
    return parsed_records(reader.text(paths).withColumnRenamed("value", "record"), F.col("_metadata.file_path"), is_vmag)


def parsed_records(rows: DataFrame, source_file: Column, is_vmag: bool) -> DataFrame:
    """Records (``record``: text from a ``>`` to the next one) in their parts."""
    rows = rows.select(source_file.alias("source_file"), F.regexp_replace("record", r"^(?:\uFEFF)?>", "").alias("record"))
    head = F.regexp_replace(F.regexp_extract("record", r"^([^\r\n]*)", 1), r"\s+$", "")
    name = F.regexp_extract(head, r"^(\S*)", 1)
    body = F.regexp_replace(F.regexp_replace("record", r"^[^\r\n]*", ""), r"\s", "")
    return rows.filter(F.trim("record") != "").select(
        "source_file", F.lit(is_vmag).alias("is_vmag"),
        F.when(F.lit(is_vmag), file_stem(F.col("source_file"))).otherwise(name).alias("genome"),
        name.alias("name"), F.regexp_extract(head, r"^\S*\s+(.*)$", 1).alias("description"), body.alias("seq"),
    )


def read_sequences(spark: SparkSession, single: str | None = None, vmag_dir: str | None = None, extensions: tuple[str, ...] = NUCLEOTIDE) -> DataFrame:
    """Single-contig file, folder of multi-contig genomes, or both; one of them must be given."""
    parts = []
    if single:
        parts.append(read_fasta(spark, single))
    if vmag_dir:
        parts.append(read_fasta(spark, vmag_dir, True, extensions))
    if not parts:
        raise ValueError("a single-contig file or a folder of genomes is needed")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def protein_records(spark: SparkSession, folder: str) -> DataFrame:
    """Proteins of ``single_contig_proteins.faa`` and ``vMAG_proteins/*.faa`` below ``folder``; an error if neither exists."""
    single, many = f"{folder}/single_contig_proteins.faa", f"{folder}/vMAG_proteins"
    there = [p if exists(spark, p) else None for p in (single, many)]
    if not any(there):
        raise FileNotFoundError(f"no protein file below {folder}")
    return read_sequences(spark, *there, extensions=("faa",))


def last_of_each_name(records: DataFrame) -> DataFrame:
    """One record for each name; of repeated names the one of the last file and largest sequence."""
    top = F.max_by(F.struct(*records.columns), F.struct(*[c for c in ("source_file", "description", "seq") if c in records.columns]))
    return records.groupBy("name").agg(top.alias("r")).select("r.*")


def gene_index(records: DataFrame) -> DataFrame:
    """Protein records with headers ``contig_n # start # end # strand # ...`` as the gene index; other headers raise.

    Genome: the file's stem in multi-contig genomes, else the contig.
    """
    parts = F.split("description", r"\s*#\s*")
    at = lambda k: F.try_element_at(parts, F.lit(k))
    number = F.regexp_extract("name", r"_(\d+)$", 1)
    good = (number != "") & at(2).rlike(r"^\d+$") & at(3).rlike(r"^\d+$") & at(4).rlike(r"^[+-]?1$")
    checked = lambda c: F.when(good, c).otherwise(F.raise_error(F.concat(F.lit("bad protein header: "), "name", F.lit(" "), "description")))
    contig = contig_of(F.col("name"))
    return records.select(
        F.when(F.col("is_vmag"), F.col("genome")).otherwise(contig).alias("genome"), contig.alias("contig"), F.col("name").alias("protein"),
        checked(F.try_to_number(number, F.lit("999999999999")).cast("long")).alias("gene_number"),
        at(2).try_cast("long").alias("contig_pos_start"), at(3).try_cast("long").alias("contig_pos_end"), at(4).try_cast("int").alias("frame"), "is_vmag",
    )
