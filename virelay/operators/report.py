"""Final table, category counts and annotated protein sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FINAL_COLUMNS
from ..sources.fasta import last_of_each_name
from .curate import CLASS_ORDER, CONFIDENCE_ORDER, rank_of

#: Where descriptions of proteins with a PHROG top hit come from, in order.
PHROG_FALLBACK = ("dbCAN", "KEGG", "FOAM", "METABOLIC", "Pfam")


def final_table(genes: DataFrame) -> DataFrame:
    """The display columns, sorted by class, confidence and protein."""
    rows = genes.orderBy(rank_of("classification", CLASS_ORDER), rank_of("viral_origin_confidence", CONFIDENCE_ORDER), "protein")
    return rows.select(*FINAL_COLUMNS)


def category_counts(genes: DataFrame) -> DataFrame:
    """Distinct proteins by classification and confidence; no confidence counts as low."""
    level = F.coalesce("viral_origin_confidence", F.lit("low"))
    return genes.groupBy("classification", level.alias("viral_origin_confidence")).agg(F.countDistinct("protein").alias("n_proteins"))


def header_description() -> Column:
    """``"id description"`` of the top hit; of PHROG hits the first other database with both, else nothing."""
    def quoted(a: Column, b: Column) -> Column:
        return F.concat(F.lit('"'), a, F.lit(" "), b, F.lit('"'))

    full = lambda c: F.coalesce(c, F.lit("")) != ""
    others = [F.when(full(F.col(f"{p}_hmm_id")) & full(F.col(f"{p}_description")), quoted(F.col(f"{p}_hmm_id"), F.col(f"{p}_description"))) for p in (x.lower() for x in PHROG_FALLBACK)]
    a, b = F.col("top_hit_hmm_id"), F.col("top_hit_description")
    own = F.when(full(a) & full(b), quoted(a, b)).when(full(a) | full(b), F.concat(F.lit('"'), F.coalesce(F.nullif(a, F.lit("")), b), F.lit('"'))).otherwise(F.lit(""))
    return F.when(F.col("top_hit_db") == "PHROG", F.coalesce(*others, F.lit(""))).otherwise(own)


def category_sequences(members: dict[str, DataFrame], proteins: DataFrame) -> DataFrame:
    """category, confidence (high, medium, low and all), name, description, seq of each class's proteins; of repeated names the last record."""
    rows = None
    for name, table in members.items():
        own = table.select(F.lit(name).alias("category"), F.coalesce("viral_origin_confidence", F.lit("low")).alias("confidence"), F.col("protein").alias("name"), header_description().alias("description"))
        rows = own if rows is None else rows.unionByName(own)
    rows = rows.dropDuplicates(["category", "name"])
    known = proteins.select(*[c for c in ("source_file", "name", "description", "seq") if c in proteins.columns])
    known = last_of_each_name(known.join(rows.select("name").distinct(), "name", "left_semi"))
    rows = rows.join(known.select("name", "seq"), "name")
    return rows.withColumn("confidence", F.explode(F.array("confidence", F.lit("all")))).select("category", "confidence", "name", "description", "seq")


def missing_sequences(members: dict[str, DataFrame], proteins: DataFrame) -> DataFrame:
    """Proteins of a class without a sequence record: category, name."""
    rows = None
    for name, table in members.items():
        own = table.select(F.lit(name).alias("category"), F.col("protein").alias("name"))
        rows = own if rows is None else rows.unionByName(own)
    return rows.distinct().join(proteins.select("name"), "name", "left_anti").select("category", "name")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows by value of a column: value, n."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
