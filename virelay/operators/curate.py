"""Descriptions, top hit, class membership, keyword rules, final classification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CLASSES, DATABASES, EngineConfig
from ..functions.keywords import any_column, any_of, matches
from ..functions.names import strip_suffix, strip_version

#: How a database's ids are compared with those of descriptions.
NORMALIZE = {"Pfam": strip_version, "dbCAN": strip_suffix}


def described(genes: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Adds ``<db>_description`` of each database's hit.

    Ids of Pfam are compared without version and with Pfam's descriptions only,
    those of dbCAN up to the first ``_``; the others exactly, with any database's.
    Of several descriptions of an id the least is taken, so rows never multiply.
    """
    out = genes
    for db in DATABASES:
        rule = NORMALIZE.get(db, lambda c: c)
        own = descriptions.filter(F.col("db") == db) if db == "Pfam" else descriptions
        key = strip_version(F.col("id")) if db == "Pfam" else F.col("id")
        names = own.groupBy(key.alias("_id")).agg(F.min("name").alias(f"{db.lower()}_description"))
        out = out.join(names, rule(F.col(f"{db.lower()}_hmm_id")) == names["_id"], "left").drop("_id")
    return out


def top_hit(compat: bool = False, databases: tuple[str, ...] = DATABASES) -> list[Column]:
    """``top_hit_hmm_id``, ``_description`` and ``_db``: the highest score, ties to the first database.

    Without any score all are null; with ``compat`` the database is then the first.
    """
    hits = [
        F.struct(F.coalesce(F.col(f"{db.lower()}_score"), F.lit("-Infinity").cast("double")).alias("s"), F.lit(-k).alias("p"), F.lit(db).alias("db"), F.col(f"{db.lower()}_hmm_id").alias("id"), F.col(f"{db.lower()}_description").alias("d"))
        for k, db in enumerate(databases)
    ]
    best = F.array_max(F.array(*hits))
    found = reduce(lambda a, b: a | b, [F.col(f"{db.lower()}_score").isNotNull() for db in databases])
    return [
        F.when(found, best["id"]).alias("top_hit_hmm_id"), F.when(found, best["d"]).alias("top_hit_description"),
        (best["db"] if compat else F.when(found, best["db"])).alias("top_hit_db"),
    ]


def any_flag(*columns: str) -> Column:
    """Or of flags, null as false."""
    return any_column([F.coalesce(F.col(c), F.lit(False)) for c in columns])


def class_members(genes: DataFrame, class_ids: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Genes with an id of any database in the class list; Pfam ids without version."""
    ids = class_ids.select(F.col("id").alias("_class_id")).filter("_class_id is not null").distinct()
    keys = F.array(*[NORMALIZE["Pfam"](F.col(f"{db.lower()}_hmm_id")) if db == "Pfam" else F.col(f"{db.lower()}_hmm_id") for db in DATABASES]) if columns is None else F.array(*[F.col(c) for c in columns])
    # One semi join on the exploded ids of distinct id combinations; genes are not multiplied.
    rows = genes.withColumn("_ids", F.array_distinct(F.filter(keys, lambda x: x.isNotNull())))
    found = rows.select("_ids").distinct().select("_ids", F.explode("_ids").alias("_class_id")).join(ids, "_class_id", "left_semi").select("_ids").distinct()
    return rows.join(found, "_ids", "left_semi").drop("_ids")


def without_keywords(genes: DataFrame, hard: list[str], soft: list[str], class_ids: DataFrame, cutoffs: DataFrame, config: EngineConfig) -> DataFrame:
    """Drops genes with a hard keyword, and those with a soft one unless a hit rescues them.

    A hit rescues if its own description has a soft keyword, its id is in the
    class list as it stands, and its score and coverage reach the raised bounds
    (the database's cut-off for KEGG and FOAM ids that have one).
    """
    hard_rule, soft_rule = any_of(hard), any_of(soft)
    text = {db: F.col(f"{db.lower()}_description") for db in DATABASES}
    rows = genes.filter(~any_column([matches(text[db], hard_rule) for db in DATABASES])) if hard else genes
    if not soft:
        return rows
    ids = class_ids.select("id").filter("id is not null").distinct()
    for db in DATABASES:
        p = db.lower()
        own = ids.select(F.col("id").alias(f"_{p}_id"), F.lit(True).alias(f"_{p}_in"))
        rows = rows.join(own, rows[f"{p}_hmm_id"] == own[f"_{p}_id"], "left").drop(f"_{p}_id")
        if db in ("KEGG", "FOAM"):
            cut = cutoffs.filter(F.col("db") == db).groupBy(F.col("hmm_id").alias(f"_{p}_id")).agg(F.max("value").alias(f"_{p}_cut"))
            rows = rows.join(cut, rows[f"{p}_hmm_id"] == cut[f"_{p}_id"], "left").drop(f"_{p}_id")
    rescued = []
    for db in DATABASES:
        p = db.lower()
        least = F.coalesce(F.col(f"_{p}_cut"), F.lit(config.soft_bitscore)) if db in ("KEGG", "FOAM") else F.lit(config.soft_bitscore)
        good = matches(text[db], soft_rule) & F.col(f"_{p}_in").isNotNull() & (F.col(f"{p}_score") >= least) & (F.col(f"{p}_coverage") >= config.soft_coverage)
        rescued.append(F.coalesce(good, F.lit(False)))
    softly = any_column([matches(text[db], soft_rule) for db in DATABASES])
    return rows.filter(~softly | any_column(rescued)).select(*genes.columns)


def classified(genes: DataFrame, members: dict[str, DataFrame], key: str = "protein") -> DataFrame:
    """Adds ``classification``: the first class of ``members`` (in order) that has the protein, else ``unclassified``."""
    tagged = None
    for rank, (name, table) in enumerate(members.items()):
        own = table.select(F.col(key).alias("_key"), F.struct(F.lit(rank).alias("r"), F.lit(name).alias("n")).alias("c"))
        tagged = own if tagged is None else tagged.unionByName(own)
    best = tagged.groupBy("_key").agg(F.min("c").alias("_c"))
    return genes.join(best, genes[key] == best["_key"], "left").withColumn("classification", F.coalesce("_c.n", F.lit("unclassified"))).drop("_key", "_c")


def rank_of(column: str, order: tuple[str, ...]) -> Column:
    """A value's place in ``order``; others come last."""
    out = F.lit(len(order))
    for k, v in reversed(list(enumerate(order))):
        out = F.when(F.col(column) == v, k).otherwise(out)
    return out


#: Ranges that the last sort column is dealt into, for each value of the columns before it.
RANGES = 32


def with_places(df: DataFrame, ranks: list[str], key: str, place: str = "place") -> DataFrame:
    """``df`` sorted by small-valued ``ranks`` and a numeric ``key``, each row with its place from 1.

    Rows are numbered within ranges of the key, and the rows of all ranges before
    are added, so no task meets all rows.  Rows that tie have places of their own.
    """
    edges = sorted(set(df.approxQuantile(key, [k / RANGES for k in range(1, RANGES)], 0.005)))
    part = sum((F.when(F.col(key) >= e, 1).otherwise(0) for e in edges), F.lit(0))
    dealt, group = df.withColumn("_range", part), [*ranks, "_range"]
    before = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*group).count().select(*group, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    rows = dealt.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(key)))
    placed = rows.join(F.broadcast(sizes), group)
    return placed.select(*df.columns, (F.col("_before") + F.col("_n")).cast("long").alias(place)).orderBy(place)


CLASS_ORDER = (*CLASSES, "unclassified")
CONFIDENCE_ORDER = ("high", "medium", "low")
