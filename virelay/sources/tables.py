"""Delimited sources with fixed schemas."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .files import exists

LOG = logging.getLogger("virelay")


def read_tsv(spark: SparkSession, path: str | list[str], schema: str, header: bool = True) -> DataFrame:
    """A tab-separated table; empty fields are null."""
    return spark.read.csv(path, sep="\t", header=header, schema=schema, nullValue="", emptyValue="")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A comma-separated table with header and quoted values over several lines."""
    return spark.read.csv(path, header=True, schema=schema, multiLine=True, quote='"', escape='"', nullValue="")


def read_permissive_tsv(spark: SparkSession, path: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """A table's good rows, and the lines (``line``) that don't fit the schema; the header is the schema's names."""
    kind = T._parse_datatype_string(schema)
    full = T.StructType([*kind.fields, T.StructField("_corrupt_record", T.StringType())])
    head = "\t".join(kind.names)
    options = {"sep": "\t", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "nullValue": ""}
    lines = spark.read.text(path).filter((F.col("value") != head) & (F.trim("value") != ""))
    rows = lines.select("value", F.from_csv("value", ddl(full), options).alias("r"))
    fits = (F.size(F.split("value", "\t")) == len(kind)) & F.col("r._corrupt_record").isNull()
    return rows.filter(fits).select(*[F.col(f"r.{c}") for c in kind.names]), rows.filter(~fits).select(F.col("value").alias("line"))


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_raw_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of sequence, hmm_id, evalue, score, length, start, end; shorter ones are passed over.

    The database comes from the file's name.
    """
    from ..functions.names import database_of

    lines = spark.read.text(path).select(F.split("value", "\t").alias("f"), database_of(F.col("_metadata.file_path")).alias("db")).filter(F.size("f") >= 7)
    at = lambda k: F.get("f", F.lit(k))
    return lines.select(
        "db", at(0).alias("sequence"), at(1).alias("hmm_id"), at(2).try_cast("double").alias("evalue"), at(3).try_cast("double").alias("score"),
        at(4).try_cast("long").alias("length"), at(5).try_cast("long").alias("start"), at(6).try_cast("long").alias("end"),
    )


def read_ids(spark: SparkSession, path: str | None, column: str = "id") -> DataFrame:
    """The distinct ids of a table's column; none, with a warning, if the file or the column is missing."""
    if not exists(spark, path):
        LOG.warning("no id table at %s: no id is known", path)
        return spark.createDataFrame([], schemas.ID_SET)
    rows = spark.read.csv(path, header=True, sep="\t" if path.endswith(".tsv") else ",")
    if column not in rows.columns:
        LOG.warning("%s has no column %s: no id is known", path, column)
        return spark.createDataFrame([], schemas.ID_SET)
    return rows.select(F.col(column).cast("string").alias("id")).filter("id is not null").distinct()


def read_thresholds(spark: SparkSession, path: str | None, db: str, value: str) -> DataFrame:
    """db, hmm_id, value of an optional table with ``id`` and ``value`` columns."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.THRESHOLDS)
    rows = spark.read.csv(path, header=True)
    return rows.select(F.lit(db).alias("db"), F.col("id").alias("hmm_id"), F.col(value).try_cast("double").alias("value")).filter("value is not null")


def read_cutoffs(spark: SparkSession, path: str | None) -> DataFrame:
    """Cut-offs of any database: a table with the columns db, hmm_id and value (gathering or trusted scores, or those of KEGG and FOAM)."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.THRESHOLDS)
    rows = spark.read.csv(path, header=True, sep="\t" if path.endswith(".tsv") else ",")
    return rows.select("db", "hmm_id", F.col("value").try_cast("double").alias("value")).filter("value is not null")


def read_hit_tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Hits of tables with header (the columns of the raw hits); files that can't be read are passed over, lines that don't fit as well, both with a warning."""
    out = spark.createDataFrame([], schemas.HITS_RAW)
    for path in paths:
        if not exists(spark, path):
            LOG.warning("%s can't be read and is passed over", path)
            continue
        good, bad = read_permissive_tsv(spark, path, schemas.HITS_RAW)
        if n := bad.count():
            LOG.warning("%d lines of %s don't fit and are passed over", n, path)
        out = out.unionByName(good)
    return out


def read_keywords(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The hard and soft keywords of a rule table (a few hundred rows, held on the driver)."""
    rows = read_csv(spark, path, schemas.KEYWORDS).filter("substring is not null and type is not null").orderBy("substring").collect()
    return [r.substring for r in rows if r.type.lower() == "hard"], [r.substring for r in rows if r.type.lower() == "soft"]


def read_class_list(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.CLASS_LIST)
