"""Column functions on protein, contig, profile and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contig_of(protein: Column) -> Column:
    """A protein's contig: its name without the last ``_`` and what follows."""
    return F.regexp_replace(protein, "_[^_]*$", "")


def strip_version(hmm_id: Column) -> Column:
    """``PF00001.23`` to ``PF00001``."""
    return F.regexp_replace(hmm_id, r"\.\d+$", "")


def strip_suffix(hmm_id: Column) -> Column:
    """``GH13_2`` to ``GH13``: what stands before the first ``_``."""
    return F.substring_index(hmm_id, "_", 1)


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]+)?$", 1)


def nucleotide_file_name(path: Column) -> Column:
    """A file's name with ``.fasta`` or ``.fa`` made ``.fna``."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.(fasta|fa)$", ".fna")


# What marks a database in a file's name, in the order of the tests.
DATABASE_MARKS = (
    ("KEGG", ("KEGG", "kegg", "kofam")),
    ("FOAM", ("FOAM", "foam")),
    ("Pfam", ("Pfam", "pfam")),
    ("dbCAN", ("dbcan", "dbCAN", "dbCan")),
    ("METABOLIC", ("METABOLIC_custom", "metabolic_custom")),
    ("VOG", ("VOG", "vog")),
    ("eggNOG", ("eggNOG", "eggnog")),
    ("PHROG", ("PHROG", "phrog")),
    ("user_custom", ("user_custom",)),
)


def database_of(path: Column) -> Column:
    """The database that a profile file's own name (not its folder) stands for; null if none."""
    name = F.element_at(F.split(path, "/"), -1)
    out = F.lit(None).cast("string")
    for db, marks in reversed(DATABASE_MARKS):
        found = name.contains(marks[0])
        for m in marks[1:]:
            found = found | name.contains(m)
        out = F.when(found, db).otherwise(out)
    return out


# What is cut from profile names.
NAME_PARTS = ("_alignment", ".mafft", ".txt", ".hmm", "_protein.alignment")


def hmm_id_of(db: Column, name: Column, accession: Column) -> Column:
    """A hit's profile id, from the profile's name or accession by the database's rules."""
    plain = name
    for part in NAME_PARTS:
        plain = F.replace(plain, F.lit(part), F.lit(""))
    dotted = F.split(name, r"\.")
    return (
        F.when(db.isin("Pfam", "FOAM"), accession)
        .when(db == "eggNOG", F.get(dotted, F.lit(0)))
        .when(name.contains(".wlink.txt.mafft"), F.get(dotted, F.lit(1)))
        .otherwise(plain)
    )
