"""Profile-search hits: acceptance, best hit, pivot, virus scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DATABASES, SCORED, EngineConfig
from ..functions.names import strip_version

#: Databases with a cut-off that is final, and with one that lower scores of good E-value may also pass.
STRICT, LENIENT = ("Pfam", "METABOLIC"), ("KEGG", "FOAM")


def accepted(hits: DataFrame, thresholds: DataFrame, config: EngineConfig) -> DataFrame:
    """Hits that pass their database's rule, with ``hmm_coverage``.

    With a cut-off: scores of at least it; in lenient databases also those of at
    least a share of it if the E-value is small enough.  Without: least score and
    coverage.
    """
    cut = thresholds.groupBy("db", "hmm_id").agg(F.max("value").alias("_cut"))
    rows = hits.withColumn("hmm_coverage", (F.col("end") - F.col("start") + 1) / F.nullif("length", F.lit(0)))
    plain = (F.col("score") >= config.min_bitscore) & (F.col("hmm_coverage") >= config.min_coverage)
    lenient = (F.col("score") >= F.col("_cut")) | ((F.col("evalue") <= config.max_evalue) & (F.col("score") >= F.col("_cut") * config.bitscore_fraction))
    rule = (
        F.when(F.col("_cut").isNotNull() & F.col("db").isin(*STRICT), F.col("score") >= F.col("_cut"))
        .when(F.col("_cut").isNotNull() & F.col("db").isin(*LENIENT), lenient)
        .otherwise(plain)
    )
    return rows.join(cut, ["db", "hmm_id"], "left").filter(rule).drop("_cut")


def best_hits(hits: DataFrame, compat: bool = False) -> DataFrame:
    """One hit for each database and sequence: least E-value, then highest score, then least profile id and start.

    ``compat`` compares E-values at two significant digits.
    """
    e = F.format_string("%.1E", F.col("evalue")).cast("double") if compat else F.col("evalue")
    order = F.struct(e.isNull(), e, -F.col("score"), "hmm_id", "start", "end")
    return hits.groupBy("db", "sequence").agg(F.min_by(F.struct("hmm_id", "score", "hmm_coverage"), order).alias("h")).select(
        "db", "sequence", "h.hmm_id", F.round("h.score", 6).alias("score"), F.round("h.hmm_coverage", 3).alias("hmm_coverage")
    )


def pivoted(best: DataFrame, databases: tuple[str, ...] = DATABASES) -> DataFrame:
    """A row for each sequence with ``<db>_score``, ``<db>_hmm_id`` and ``<db>_coverage`` of a fixed list of databases."""
    out = []
    for db in databases:
        own = F.col("db") == db
        out += [F.max(F.when(own, F.col(c))).alias(f"{db.lower()}_{t}") for c, t in (("score", "score"), ("hmm_id", "hmm_id"), ("hmm_coverage", "coverage"))]
    return best.groupBy("sequence").agg(*out)


def with_vscores(best: DataFrame, vscores: DataFrame) -> DataFrame:
    """Hits whose profile has virus scores; versions of Pfam ids don't matter, the database isn't compared."""
    key = lambda db, c: F.when(F.col(db) == "Pfam", strip_version(F.col(c))).otherwise(F.col(c))
    scores = vscores.select(key("db", "id").alias("_key"), "v_score", "vl_score").filter("v_score is not null")
    return best.withColumn("_key", key("db", "hmm_id")).join(scores, "_key").drop("_key")


def wide_vscores(scored: DataFrame, compat: bool = False) -> DataFrame:
    """A row for each sequence with ``<db>_hmm_coverage``, ``<db>_v_score`` and ``<db>_vl_score`` of the scored databases.

    One conditional aggregation.  ``compat``: only sequences with a Pfam score keep any.
    """
    out = []
    for db in SCORED:
        own = F.col("db") == db
        out += [F.max(F.when(own, F.col(c))).alias(f"{db.lower()}_{c}") for c in ("hmm_coverage", "v_score", "vl_score")]
    wide = scored.groupBy("sequence").agg(*out)
    return wide.filter("pfam_v_score is not null") if compat else wide


def annotated_index(index: DataFrame, best: DataFrame, vscores: DataFrame, compat: bool = False) -> DataFrame:
    """The gene index with each protein's hits and virus scores; proteins without hits stay."""
    scores = wide_vscores(with_vscores(best.filter(F.col("db").isin(*SCORED)), vscores), compat)
    wide = pivoted(best).withColumnRenamed("sequence", "protein")
    return index.dropDuplicates().join(wide, "protein", "left").join(scores.withColumnRenamed("sequence", "protein"), "protein", "left")
