"""More operators as queries: normalised ids, keyword rules, the engine's own tables, files written and read back.

Like ``queries``, each goes over whole tables of the driver and has SQL that states
the operator in another way.  Queries of sources and sinks write to the shared
folder and read what they wrote.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..config import CircularitySettings, EngineConfig
from ..functions import names
from ..operators import circular, context, curate, hits, plugins, report, score
from ..sources import fasta, sinks, tables
from ..sources.files import scratch
from .queries import BEST_SQL, FLANK, GENES_SQL, HITS_SQL, MOBILE_SQL, PLACE, best_of, genes_of, query, raw_hits_of, table
from .resume import kept

DBS = ("KEGG", "FOAM", "Pfam", "dbCAN", "METABOLIC", "PHROG")
LOWER = tuple(db.lower() for db in DBS)

# Hits whose Pfam ids have versions and whose dbCAN ids have suffixes, and names of all kinds for them.
LONG_SQL = BEST_SQL + r""", vb AS (SELECT db, sequence, score, hmm_coverage, CASE db WHEN 'Pfam' THEN hmm_id || '.' || (sequence % 7) WHEN 'dbCAN' THEN hmm_id || '_' || (sequence % 5) ELSE hmm_id END AS hmm_id FROM best),
ks AS (SELECT DISTINCT p_partkey % 50 AS k FROM part),
vn AS (SELECT CASE WHEN k % 2 = 0 THEN 'H' || k || '.' || (k % 4) ELSE 'H' || k END AS id, CASE WHEN k % 2 = 0 THEN 'Pfam' ELSE 'KEGG' END AS db,
  CASE k % 7 WHEN 0 THEN 'putative lysin ' || k WHEN 1 THEN 'Endolysin ' || k WHEN 2 THEN 'ADP part, EC:1.2.3.4' WHEN 3 THEN 'enzyme EC 1.2.3.45' WHEN 4 THEN 'Soft thing ' || k WHEN 5 THEN 'EC 4.1.-' ELSE 'plain ' || k END AS name FROM ks WHERE k % 9 <> 0),
vl AS (SELECT b.sequence, b.db, b.hmm_id, b.score, b.hmm_coverage, min(n.name) AS de FROM vb b LEFT JOIN vn n ON
  (b.db = 'Pfam' AND n.db = 'Pfam' AND split_part(n.id, '.', 1) = split_part(b.hmm_id, '.', 1)) OR (b.db = 'dbCAN' AND n.id = split_part(b.hmm_id, '_', 1)) OR (b.db NOT IN ('Pfam', 'dbCAN') AND n.id = b.hmm_id) GROUP BY ALL)"""


def number_in(column: str):
    return F.col(column).cast("string")


def versioned_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ending = F.when(F.col("db") == "Pfam", F.concat(F.lit("."), (F.col("sequence") % 7).cast("string"))).when(F.col("db") == "dbCAN", F.concat(F.lit("_"), (F.col("sequence") % 5).cast("string"))).otherwise("")
    return best_of(spark, sf_dir).withColumn("hmm_id", F.concat("hmm_id", ending))


def kinds_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).alias("k")).distinct()


def versioned_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("k"), number_in("k")
    even = k % 2 == 0
    name = F.lit(None).cast("string")
    for r, text in reversed(list(enumerate((F.concat(F.lit("putative lysin "), n), F.concat(F.lit("Endolysin "), n), F.lit("ADP part, EC:1.2.3.4"), F.lit("enzyme EC 1.2.3.45"), F.concat(F.lit("Soft thing "), n), F.lit("EC 4.1.-"), F.concat(F.lit("plain "), n))))):
        name = F.when(k % 7 == r, text).otherwise(name)
    return kinds_of(spark, sf_dir).filter("k % 9 <> 0").select(F.concat(F.lit("H"), n, F.when(even, F.concat(F.lit("."), (k % 4).cast("string"))).otherwise("")).alias("id"), F.when(even, "Pfam").otherwise("KEGG").alias("db"), name.alias("name"))


def versioned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.described(hits.pivoted(versioned_hits(spark, sf_dir)), versioned_names(spark, sf_dir))


@query(f"WITH {LONG_SQL} SELECT sequence, " + ", ".join(f"max(hmm_id) FILTER (db = '{db}') AS {p}_hmm_id, max(de) FILTER (db = '{db}') AS {p}_description" for db, p in zip(DBS, LOWER, strict=True)) + " FROM vl GROUP BY sequence")
def desc_joins_versions(spark, sf_dir):
    """Descriptions of ids with versions (Pfam) and suffixes (dbCAN)."""
    return versioned_rows(spark, sf_dir).select("sequence", *[f"{p}_{c}" for p in LOWER for c in ("hmm_id", "description")])


RULES = {
    "words": (["lysin", "adp"], []),
    "enzymes": (["EC 1.2.3.4", "EC 4.1."], []),
    "soft": (["EC:1.2.3.4"], ["soft", "PLAIN"]),
}
MATCH = {"lysin": r"(?i)\blysin\b", "adp": r"(?i)\badp\b", "EC 1.2.3.4": r"(?i)\bEC[:\s]1\.2\.3\.4\b", "EC:1.2.3.4": r"(?i)\bEC[:\s]1\.2\.3\.4\b", "EC 4.1.": r"(?i)EC 4\.1\.", "soft": "(?i)soft", "PLAIN": "(?i)plain"}


def any_sql(words: list[str]) -> str:
    return " OR ".join(f"coalesce(regexp_matches(de, '{MATCH[w]}'), false)" for w in words) or "false"


def rule_sql(name: str) -> str:
    hard, soft = RULES[name]
    return f"""SELECT '{name}' AS rule, sequence FROM (SELECT sequence, bool_or({any_sql(hard)}) AS hard, bool_or({any_sql(soft)}) AS soft,
  bool_or(({any_sql(soft)}) AND hmm_id IN (SELECT id FROM cls) AND hmm_coverage >= 0.75 AND score >= coalesce((SELECT max(cut) FROM cf WHERE cf.db = vl.db AND cf.id = vl.hmm_id), 75)) AS rescued FROM vl GROUP BY sequence) WHERE NOT hard AND (NOT soft OR rescued)"""


@query(f"WITH {LONG_SQL}, cls AS (SELECT 'H' || k AS id FROM ks WHERE k % 3 <> 0), cf AS (SELECT db, 'H' || k AS id, 20.0 + k * 3 AS cut FROM ks, (VALUES ('KEGG'), ('FOAM')) d(db) WHERE k % 4 = 1) " + " UNION ALL ".join(map(rule_sql, RULES)))
def keyword_rules(spark, sf_dir):
    """Hard and soft keywords over six descriptions: whole words, enzyme numbers, rescue by a hit's own bounds."""
    rows = versioned_rows(spark, sf_dir)
    kinds = kinds_of(spark, sf_dir)
    ids = kinds.filter("k % 3 <> 0").select(F.concat(F.lit("H"), number_in("k")).alias("id"))
    cuts = kinds.filter("k % 4 = 1").select(F.explode(F.array(F.lit("KEGG"), F.lit("FOAM"))).alias("db"), F.concat(F.lit("H"), number_in("k")).alias("hmm_id"), (20.0 + F.col("k") * 3).alias("value"))
    out = None
    for name, (hard, soft) in RULES.items():
        own = curate.without_keywords(rows, hard, soft, ids, cuts, EngineConfig()).select(F.lit(name).alias("rule"), "sequence")
        out = own if out is None else out.unionByName(own)
    return out


@query(f"WITH {LONG_SQL} SELECT DISTINCT sequence FROM vl WHERE CASE db WHEN 'Pfam' THEN split_part(hmm_id, '.', 1) ELSE hmm_id END IN (SELECT 'H' || k FROM ks WHERE k % 11 = 3)")
def class_semi_versions(spark, sf_dir):
    """Members of a class list, Pfam ids compared without version and dbCAN ids as they are."""
    ids = kinds_of(spark, sf_dir).filter("k % 11 = 3").select(F.concat(F.lit("H"), number_in("k")).alias("id"))
    return curate.class_members(versioned_rows(spark, sf_dir), ids).select("sequence")


WIDE_COLUMNS = [f"{p}_{c}" for p in LOWER for c in ("score", "hmm_id", "coverage")]
SCORED_SQL = """vs AS (SELECT CASE WHEN k % 2 = 0 THEN 'H' || k || '.9' ELSE 'H' || k END AS id, k * 0.25 AS v, k * 0.5 AS w FROM ks WHERE k % 4 <> 3),
sc AS (SELECT b.sequence, b.db, b.hmm_coverage, v, w FROM vb b JOIN vs ON CASE b.db WHEN 'Pfam' THEN split_part(b.hmm_id, '.', 1) ELSE b.hmm_id END = split_part(vs.id, '.', 1) WHERE b.db IN ('KEGG', 'Pfam', 'PHROG'))"""


def index_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gene index of customers, most of whom are no supplier and so have no hit."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("protein"), F.col("c_nationkey").alias("contig"), F.concat(F.lit("g"), (F.col("c_nationkey") % 3).cast("string")).alias("genome"), (F.col("c_custkey") * 100).alias("contig_pos_start"),
    )
    return rows.unionByName(rows.filter("protein % 10 = 0"))


@query(f"WITH {LONG_SQL}, {SCORED_SQL}, i AS (SELECT c_custkey AS protein, c_nationkey AS contig, 'g' || (c_nationkey % 3) AS genome, c_custkey * 100 AS contig_pos_start FROM customer), "
       + "h AS (SELECT sequence, " + ", ".join(f"max({c}) FILTER (db = '{db}') AS {p}_{t}" for db, p in zip(DBS, LOWER, strict=True) for c, t in (("score", "score"), ("hmm_id", "hmm_id"), ("hmm_coverage", "coverage"))) + " FROM vb GROUP BY sequence), "
       + "s AS (SELECT sequence, " + ", ".join(f"max({c}) FILTER (db = '{db}') AS {db.lower()}_{t}" for db in ("KEGG", "Pfam", "PHROG") for c, t in (("hmm_coverage", "hmm_coverage"), ("v", "v_score"), ("w", "vl_score"))) + " FROM sc GROUP BY sequence) "
       + "SELECT i.*, h.* EXCLUDE (sequence), s.* EXCLUDE (sequence) FROM i LEFT JOIN h ON i.protein = h.sequence LEFT JOIN s ON i.protein = s.sequence")
def annotated_index(spark, sf_dir):
    """Genes with the hits and virus scores of their proteins; genes without any stay, repeated rows don't."""
    k, n = F.col("k"), number_in("k")
    scores = kinds_of(spark, sf_dir).filter("k % 4 <> 3").select(F.concat(F.lit("H"), n, F.when(k % 2 == 0, ".9").otherwise("")).alias("id"), (k * 0.25).alias("v_score"), (k * 0.5).alias("vl_score"), F.when(k % 2 == 0, "Pfam").otherwise("KEGG").alias("db"))
    found = hits.annotated_index(index_of(spark, sf_dir), versioned_hits(spark, sf_dir), scores)
    return found.dropDuplicates()


@query(f"""WITH {HITS_SQL}, tied AS (SELECT *, CAST(printf('%.1E', evalue * (1 + l_linenumber / 300.0)) AS DOUBLE) AS e2 FROM ok)
SELECT db, sequence, hmm_id, score, round(cov, 3) AS hmm_coverage FROM (SELECT *, row_number() OVER (PARTITION BY db, sequence ORDER BY e2, score DESC, hmm_id, "start", "end") AS r FROM tied) WHERE r = 1""")
def best_hit_compat(spark, sf_dir):
    """The best hit where E-values count at two digits only, so that many tie."""
    raw, cuts = raw_hits_of(spark, sf_dir)
    found = hits.accepted(raw, cuts, EngineConfig()).withColumn("evalue", F.col("evalue") * (1 + F.col("l_linenumber") / 300.0))
    return hits.best_hits(found, compat=True)


CONTIGS_SQL = """b AS (SELECT p_partkey AS k, translate(upper(substr(md5(p_name), 1, 24)), '0123456789BDEF', 'ACGTACGTACGTAC') AS t, translate(upper(md5(p_type)), '0123456789BDEF', 'ACGTACGTACGTAC') AS x FROM part),
c AS (SELECT k, CASE k % 7 WHEN 0 THEN t || 'N' || x || t WHEN 1 THEN t || 'N' || x || 'R' || reverse(translate(t, 'ACTG', 'TGAC')) WHEN 2 THEN 'N' || x || t || 'R' WHEN 3 THEN repeat('A', 24) || 'N' || x || 'C' || repeat('A', 24)
  WHEN 4 THEN 'NNNNNNNN' || substr(t, 1, 16) || 'G' || x || 'R' || 'NNNNNNNN' || substr(t, 1, 16) WHEN 5 THEN repeat(t || x, 4) ELSE substr(t, 1, 9) END AS seq FROM b)"""


def contigs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up contigs with direct, inverted, doubtful and no repeats."""
    code = lambda c: F.translate(F.upper(c), "0123456789BDEF", "ACGTACGTACGTAC")
    t, x, k = F.col("t"), F.col("x"), F.col("p_partkey") % 7
    rows = table(spark, sf_dir, "part").select("p_partkey", code(F.substring(F.md5(F.col("p_name").cast("binary")), 1, 24)).alias("t"), code(F.md5(F.col("p_type").cast("binary"))).alias("x"))
    n = F.concat(F.lit("NNNNNNNN"), F.substring(t, 1, 16))
    a = F.lit("A" * 24)
    kinds = (F.concat(t, F.lit("N"), x, t), F.concat(t, F.lit("N"), x, F.lit("R"), F.reverse(F.translate(t, "ACTG", "TGAC"))), F.concat(F.lit("N"), x, t, F.lit("R")), F.concat(a, F.lit("N"), x, F.lit("C"), a), F.concat(n, F.lit("G"), x, F.lit("R"), n), F.repeat(F.concat(t, x), F.lit(4)))
    seq = F.substring(t, 1, 9)
    for r, kind in reversed(list(enumerate(kinds))):
        seq = F.when(k == r, kind).otherwise(seq)
    return rows.select(F.col("p_partkey").cast("string").alias("name"), seq.alias("seq"))


CIRCULAR_SQL = CONTIGS_SQL + """, d AS (SELECT *, length(seq) AS n, coalesce(list_min(list_filter(range(CAST(ceil(length(seq) / 2.0) AS BIGINT) + 1, length(seq) - 18), lambda p: starts_with(seq, substr(seq, p)))), 0) AS dp,
  coalesce(list_max(list_filter(range(20, least(1000, length(seq)) + 1), lambda m: substr(seq, 1, m) = substr(reverse(translate(seq, 'ACTG', 'TGAC')), 1, m))), 0) AS ip FROM c),
r AS (SELECT *, CASE WHEN dp > 0 AND n - dp + 1 >= ip THEN 'DTR' WHEN ip > 0 THEN 'ITR' END AS kind, CASE WHEN dp > 0 AND n - dp + 1 >= ip THEN substr(seq, dp) WHEN ip > 0 THEN substr(seq, 1, ip) END AS rep FROM d),
q AS (SELECT *, (n - 14.0) / len(list_distinct([substr(seq, i, 15) FOR i IN range(1, n - 13)])) AS mult, (n - length(replace(seq, rep, ''))) // length(rep) AS cnt, (length(rep) - length(replace(rep, 'N', ''))) / length(rep) AS nf,
  greatest(length(rep) - length(replace(rep, 'A', '')), length(rep) - length(replace(rep, 'C', '')), length(rep) - length(replace(rep, 'G', '')), length(rep) - length(replace(rep, 'T', '')), length(rep) - length(replace(rep, 'N', ''))) / length(rep) AS mf FROM r)"""
REASON_SQL = "CASE WHEN n >= 15 AND mult > 1.5 THEN 'Multiple genome copies detected' WHEN nf > 0.2 THEN 'Too many ambiguous bases in TR' WHEN cnt > 8 THEN 'Repetitive TR sequence' WHEN mf > 0.7 THEN 'Low complexity TR' END"


@query(f"""WITH {CIRCULAR_SQL} SELECT CAST(k AS VARCHAR) AS contig, n AS contig_length, CASE WHEN n >= 15 THEN round(mult, 6) END AS kmer_freq, kind AS prediction_type, CAST(length(rep) AS BIGINT) AS repeat_length, CAST(cnt AS BIGINT) AS repeat_count,
  round(nf, 6) AS repeat_n_freq, round(mf, 6) AS repeat_mode_base_freq, rep AS repeat_seq, {REASON_SQL} IS NOT NULL AS flagged, {REASON_SQL} AS reason FROM q""")
def circularity(spark, sf_dir):
    """The engine's circularity rows: repeats, their measures, quality flags and reasons."""
    out = circular.terminal_repeats(contigs_of(spark, sf_dir), CircularitySettings())
    return out.withColumns({c: F.round(c, 6) for c in ("kmer_freq", "repeat_n_freq", "repeat_mode_base_freq")})


@query()
def circularity_of_texts(spark, sf_dir):
    """The engine's circularity over the whole texts of all documents; tests hold it against brute force."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("seq"))
    out = circular.terminal_repeats(docs, CircularitySettings())
    return out.select("contig", "contig_length", F.round("kmer_freq", 6).alias("kmer_freq"), "prediction_type", "repeat_length", F.md5(F.col("repeat_seq").cast("binary")).alias("repeat_digest"), "reason")


@query(f"WITH {CIRCULAR_SQL} SELECT CAST(k AS VARCHAR) AS contig, n AS contig_length, kind AS prediction_type, rep AS repeat_seq FROM q WHERE kind IS NOT NULL")
def circular_file(spark, sf_dir):
    """The table of circular contigs, written as one TSV file and read back; contigs without a repeat are not in it."""
    path = scratch(spark, "circular") + "/circular_contigs.tsv"
    found = circular.terminal_repeats(contigs_of(spark, sf_dir)).filter("prediction_type is not null")
    sinks.write_tsv(found, path, {c: c for c in schemas.CIRCULAR_COLUMNS})
    back = tables.read_tsv(spark, path, ", ".join(f"{c} {'long' if c in ('contig_length', 'repeat_length', 'repeat_count') else 'double' if c.endswith('freq') else 'string'}" for c in schemas.CIRCULAR_COLUMNS))
    return back.select("contig", "contig_length", "prediction_type", "repeat_seq")


@query(f"""WITH {GENES_SQL}, m AS (SELECT g.*, g.partkey IN ({MOBILE_SQL}) AS a, g.partkey % 10 = 3 AS b FROM genes g)
SELECT x.contig, x.n, {', '.join(f"bool_or(y.{c} AND ((y.n < x.n AND x.s - y.s <= {FLANK}) OR (y.n > x.n AND y.s - x.e <= {FLANK}))) AS {c}_mge_flank" for c in "ab")} FROM m x JOIN m y ON x.contig = y.contig AND abs(y.n - x.n) <= {FLANK} + 1 GROUP BY x.contig, x.n""")
def mge_flanks(spark, sf_dir):
    """Members of id sets on either side, two sets at once."""
    ids = table(spark, sf_dir, "part").filter(F.col("p_brand").isin("Brand#11", "Brand#22", "Brand#33")).select(F.col("p_partkey").alias("id"))
    genes = context.in_set(genes_of(spark, sf_dir), ids, "partkey", "marked").withColumn("third", F.col("partkey") % 10 == 3)
    return context.set_flanks(genes, {"a_mge": "marked", "b_mge": "third"}, FLANK, both=True, **PLACE).select("contig", "n", "a_mge_flank", "b_mge_flank")


class Linear:
    """A stand-in for a trained model: the probability grows with two features."""

    features, thresholds = ["kegg", "near_flank", "absent"], {"high": 0.7, "medium": 0.4}

    def probability(self, rows):
        return (rows["kegg"] / 20 + rows["near_flank"] / 4 + rows["absent"]).clip(0, 1)


@query(f"""WITH {GENES_SQL}, f AS (SELECT contig, n, kegg, CASE WHEN pfam IS NOT NULL THEN pfam >= 5 END AS flank FROM genes),
c AS (SELECT contig, flank, count(*) AS k FROM f WHERE flank IS NOT NULL GROUP BY contig, flank), m AS (SELECT contig, arg_max(flank, k * 2 + CAST(NOT flank AS INT)) AS mode FROM c GROUP BY contig), d AS (SELECT contig, median(kegg) AS mid FROM f GROUP BY contig),
p AS (SELECT f.contig, n, least(1.0, coalesce(kegg, mid) / 20 + CAST(coalesce(flank, mode, false) AS INT) / 4.0) AS p FROM f JOIN d USING (contig) LEFT JOIN m USING (contig))
SELECT contig, n, round(p, 6) AS viral_prob, CASE WHEN p >= 0.7 THEN 'high' WHEN p >= 0.4 THEN 'medium' ELSE 'low' END AS viral_origin_confidence FROM p""")
def model_confidence(spark, sf_dir):
    """Probabilities of a model over imputed features, in Arrow batches, and their labels."""
    genes = genes_of(spark, sf_dir).withColumn("near_flank", F.when(F.col("pfam").isNotNull(), F.col("pfam") >= 5))
    out = score.scored(genes, Linear(), ("contig",))
    return out.select("contig", "n", F.round("viral_prob", 6).alias("viral_prob"), "viral_origin_confidence")


DISPLAY = list(schemas.FINAL_COLUMNS)


@query(f"""WITH {LONG_SQL}, w AS (SELECT sequence, {', '.join(f"max({c}) FILTER (db = '{db}') AS {p}_{t}" for db, p in zip(DBS, LOWER, strict=True) for c, t in (('hmm_id', 'hmm_id'), ('de', 'description')))} FROM vl GROUP BY sequence),
t AS (SELECT sequence, hmm_id, de, db FROM (SELECT *, row_number() OVER (PARTITION BY sequence ORDER BY score DESC, CASE db {' '.join(f"WHEN '{db}' THEN {k}" for k, db in enumerate(DBS))} END) AS r FROM vl) WHERE r = 1),
a AS (SELECT DISTINCT sequence FROM vl WHERE hmm_id LIKE 'H1%'), b AS (SELECT DISTINCT sequence FROM vl WHERE hmm_id LIKE 'H2%')
SELECT CAST(w.sequence AS VARCHAR) AS protein, 'c' || (w.sequence % 10) AS contig, 'g' AS genome, CASE WHEN w.sequence IN (FROM a) THEN 'metabolic' WHEN w.sequence IN (FROM b) THEN 'regulatory' ELSE 'unclassified' END AS classification,
  CASE w.sequence % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'low' END AS viral_origin_confidence, {', '.join(f'{p}_{c}' for p in LOWER for c in ('hmm_id', 'description'))}, t.hmm_id AS top_hit_hmm_id, t.de AS top_hit_description, t.db AS top_hit_db FROM w JOIN t USING (sequence)""")
def final_results(spark, sf_dir):
    """The final table: top hits, classes in order of priority, the display columns, written as one file with titles and read back."""
    s = F.col("sequence")
    rows = versioned_rows(spark, sf_dir).select("*", *curate.top_hit())
    rows = rows.select("*", s.cast("string").alias("protein"), F.concat(F.lit("c"), (s % 10).cast("string")).alias("contig"), F.lit("g").alias("genome"), F.when(s % 3 == 0, "high").when(s % 3 == 1, "low").alias("viral_origin_confidence"))
    like = lambda x: rows.filter(" or ".join(f"{p}_hmm_id like '{x}%'" for p in LOWER))
    path = scratch(spark, "final") + "/final_results.tsv"
    sinks.write_tsv(report.final_table(curate.classified(rows, {"metabolic": like("H1"), "regulatory": like("H2")})), path, schemas.FINAL_COLUMNS)
    back = tables.read_tsv(spark, path, ", ".join(f"`{x}` string" for x in schemas.FINAL_COLUMNS.values()))
    return back.toDF(*DISPLAY)


@query("""SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS price, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS priority, o_orderkey % 3 = 0 AS flag FROM orders""")
def tsv_round_trip(spark, sf_dir):
    """A table with gaps and booleans as one TSV file, read back with its schema."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("string").alias("price"), F.when(k % 2 == 0, F.col("o_orderpriority")).alias("priority"), (k % 3 == 0).alias("flag"))
    path = scratch(spark, "table") + "/orders.tsv"
    sinks.write_tsv(rows.orderBy("o_orderkey"), path)
    return tables.read_tsv(spark, path, "o_orderkey long, o_orderstatus string, price string, priority string, flag boolean")


@query("""SELECT event_id, user_id, value, 'good' AS kind FROM events WHERE event_id % 5 <> 0 UNION ALL SELECT count(*), 0, 0.0, 'bad' FROM events WHERE event_id % 5 = 0""")
def permissive_tsv(spark, sf_dir):
    """Good rows of a table with broken lines, and the number of the others."""
    e = F.col("event_id")
    line = F.when(e % 10 == 0, F.concat_ws("\t", e.cast("string"), F.lit("x"))).when(e % 5 == 0, F.concat_ws("\t", F.lit("none"), F.col("user_id").cast("string"), F.lit("v"))).otherwise(F.concat_ws("\t", e.cast("string"), F.col("user_id").cast("string"), F.col("value").cast("string")))
    path = scratch(spark, "lines")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    good, bad = tables.read_permissive_tsv(spark, path, "event_id long, user_id long, value double")
    return good.withColumn("kind", F.lit("good")).unionByName(bad.agg(F.count(F.lit(1)).alias("event_id"), F.lit(0).cast("long").alias("user_id"), F.lit(0.0).alias("value"), F.lit("bad").alias("kind")))


@query("""SELECT 'KEGG' AS db, 's' || l_suppkey AS sequence, 'H' || l_partkey AS hmm_id, CAST(l_quantity AS DOUBLE) AS score, CAST(100 AS BIGINT) AS length, CASE WHEN l_linenumber % 4 = 2 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS "start" FROM lineitem WHERE l_linenumber % 4 <> 1
UNION ALL SELECT 'Pfam', 's' || s_suppkey, 'PF1', s_acctbal, 7, 1 FROM supplier""")
def raw_hit_files(spark, sf_dir):
    """Hit lines of two files, the database from the file's name; short lines are passed over, and what is no number is null."""
    n = F.col("l_linenumber")
    c = lambda x: F.col(x).cast("string")
    lines = table(spark, sf_dir, "lineitem").select(F.when(n % 4 == 1, F.concat_ws("\t", c("l_suppkey"), F.lit("short"))).otherwise(
        F.concat_ws("\t", F.concat(F.lit("s"), c("l_suppkey")), F.concat(F.lit("H"), c("l_partkey")), F.lit("1.0E-09"), c("l_quantity"), F.lit("100"), F.when(n % 4 == 2, "?").otherwise(c("l_linenumber")), F.lit("50"))).alias("value"))
    folder = scratch(spark, "hits")
    others = table(spark, sf_dir, "supplier").select(F.concat_ws("\t", F.concat(F.lit("s"), c("s_suppkey")), F.lit("PF1"), F.lit("1"), c("s_acctbal"), F.lit("7"), F.lit("1"), F.lit("7")).alias("value"))
    for name, rows in (("kofam_hits.tsv", lines), ("Pfam-A.tsv", others)):
        rows.write.text(f"{folder}/{name}.parts")
        sinks.concatenated(spark, f"{folder}/{name}.parts", f"{folder}/{name}")
    return tables.read_raw_hits(spark, [f"{folder}/kofam_hits.tsv", f"{folder}/Pfam-A.tsv"]).select("db", "sequence", "hmm_id", "score", "length", "start")


@query("""SELECT DISTINCT 'n' || n_nationkey AS id, 'there' AS source FROM nation UNION ALL SELECT 'KEGG ' || 'H' || p_partkey, CAST(round(p_retailprice, 2) AS VARCHAR) FROM part WHERE p_partkey % 3 = 0""")
def id_and_threshold_files(spark, sf_dir):
    """Id sets and cut-offs of files; files that don't exist are empty, values that are no numbers go."""
    folder = scratch(spark, "ids")
    ids = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.lit("x").alias("name"))
    ids.unionByName(ids).write.csv(f"{folder}/ids.csv", header=True)
    k = F.col("p_partkey")
    table(spark, sf_dir, "part").select(F.concat(F.lit("H"), k.cast("string")).alias("id"), F.when(k % 3 == 0, F.round("p_retailprice", 2).cast("string")).when(k % 3 == 1, "none").alias("threshold")).write.csv(f"{folder}/cuts.csv", header=True)
    cuts = tables.read_thresholds(spark, f"{folder}/cuts.csv", "KEGG", "threshold").unionByName(tables.read_thresholds(spark, f"{folder}/missing.csv", "FOAM", "cutoff_full"))
    found = tables.read_ids(spark, f"{folder}/ids.csv").unionByName(tables.read_ids(spark, f"{folder}/missing.csv")).unionByName(tables.read_ids(spark, f"{folder}/ids.csv", "no_such_column"))
    return found.withColumn("source", F.lit("there")).unionByName(cuts.select(F.concat_ws(" ", "db", "hmm_id").alias("id"), F.col("value").cast("string").alias("source")))


@query(r"""SELECT doc_id, lang FROM documents WHERE NOT coalesce(contains(lower(text), 'oner' || chr(10)) OR regexp_matches(text, '(?i)"the"') OR contains(lower(text), 'ingth'), false)""")
def keyword_file(spark, sf_dir):
    """Keywords of a quoted CSV file, one of them over two lines; rows that are neither hard nor soft don't count."""
    from ..functions import keywords as kw

    folder = scratch(spark, "keywords")
    lines = ["substring,type", '"oner', '",hard', '"""the""",HARD', "ingth,hard", "never,other", "thaou,soft"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(folder)
    hard, soft = tables.read_keywords(spark, folder)
    if soft != ["thaou"]:
        raise ValueError(f"soft keywords: {soft}")
    return table(spark, sf_dir, "documents").filter(~kw.matches(F.col("text"), kw.any_of(hard))).select("doc_id", "lang")


@query(r"""SELECT 'g' || (doc_id % 4) AS genome, 'd_' || doc_id AS name, 'lang ' || lang AS description, md5(regexp_replace(text, '[\s\x0B]', '', 'g')) AS digest, 'f_g' || (doc_id % 4) || '.fna' AS file_name FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL""")
def fasta_files(spark, sf_dir):
    """Texts as FASTA files of several genomes, found in their folder by extension and read again: records, genomes, new file names."""
    folder = scratch(spark, "fasta")
    docs = table(spark, sf_dir, "documents").filter("text is not null and lang is not null")
    rows = docs.select(F.concat(F.lit("g"), (F.col("doc_id") % 4).cast("string")).alias("genome"), F.concat(F.lit("d_"), F.col("doc_id").cast("string")).alias("name"), F.concat(F.lit("lang "), "lang").alias("description"), F.col("text").alias("seq"))
    sinks.write_fasta(rows, f"{folder}/.parts", by=["genome"])
    for k in range(4):  # the test's own four groups
        if tables.exists(spark, f"{folder}/.parts/genome=g{k}"):
            sinks.concatenated(spark, f"{folder}/.parts/genome=g{k}", f"{folder}/genomes/g{k}.{('fasta', 'fa')[k % 2]}")
    spark.createDataFrame([(">other\nACGT",)], "value string").coalesce(1).write.text(f"{folder}/other")
    sinks.concatenated(spark, f"{folder}/other", f"{folder}/genomes/notes.txt")
    back = fasta.read_sequences(spark, vmag_dir=f"{folder}/genomes")
    return back.select("genome", "name", "description", F.md5(F.col("seq").cast("binary")).alias("digest"), F.concat(F.lit("f_"), names.nucleotide_file_name(F.col("source_file"))).alias("file_name"))


@query("""SELECT 'p_' || (c_custkey % 100) AS name, max(lpad(CAST(c_custkey AS VARCHAR), 8, '0')) AS seq, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY c_custkey % 100""")
def protein_files(spark, sf_dir):
    """Proteins of both kinds of files below a folder; of repeated names the last record counts."""
    folder = scratch(spark, "proteins")
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(key, F.concat(F.lit("p_"), (key % 100).cast("string")).alias("name"), F.lit("").alias("description"), F.lpad(key.cast("string"), 8, "0").alias("seq"))
    edge = rows.agg(F.max("c_custkey")).first()[0] // 2
    for part, target in ((rows.filter(key <= edge), "single_contig_proteins.faa"), (rows.filter(key > edge), "vMAG_proteins/v.faa")):
        sinks.write_fasta(part, f"{folder}/.parts")
        sinks.concatenated(spark, f"{folder}/.parts", f"{folder}/{target}")
    found = fasta.protein_records(spark, folder)
    return fasta.last_of_each_name(found).select("name", "seq").join(found.groupBy("name").agg(F.count(F.lit(1)).alias("n")), "name")


@query("""WITH m AS (SELECT 'AMGs' AS category, d.doc_id, d.text, CASE quality WHEN 1 THEN 'high' ELSE 'low' END AS c FROM labels l JOIN documents d USING (doc_id) WHERE toxic = 0)
SELECT 'faa_metabolic/' || category || '_' || c || '_confidence.faa' AS file, CAST(doc_id AS VARCHAR) AS name, md5(regexp_replace(coalesce(text, ''), '[\\s\\x0B]', '', 'g')) AS digest FROM m
UNION ALL SELECT 'faa_metabolic/AMGs_all.faa', CAST(doc_id AS VARCHAR), md5(regexp_replace(coalesce(text, ''), '[\\s\\x0B]', '', 'g')) FROM m""".replace("\\\\", "\\"))
def category_files(spark, sf_dir):
    """One sequence file for each class and confidence, and one for all; a file without sequences is empty."""
    folder = scratch(spark, "classes")
    rows = table(spark, sf_dir, "labels").filter("toxic = 0").select(F.col("doc_id").cast("string").alias("protein"), F.when(F.col("quality") == 1, "high").alias("viral_origin_confidence"))
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("top_hit_hmm_id", "top_hit_description", "top_hit_db", *[f"{p}_{x}" for p in ("dbcan", "kegg", "foam", "metabolic", "pfam") for x in ("hmm_id", "description")])})
    proteins = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("name"), F.coalesce("text", F.lit("")).alias("seq"))
    levels = ("high", "medium", "low", "all")
    files = {("metabolic", level): f"faa_metabolic/AMGs_{level}{'' if level == 'all' else '_confidence'}.faa" for level in levels}
    sinks.write_category_files(report.category_sequences({"metabolic": rows}, proteins), folder, files)
    out = None
    for name in files.values():
        own = fasta.read_fasta(spark, f"{folder}/{name}").select(F.lit(name).alias("file"), "name", F.md5(F.col("seq").cast("binary")).alias("digest"))
        out = own if out is None else out.unionByName(own)
    return out


@query("""SELECT n_nationkey AS k, n_name AS name, CAST(1 AS BIGINT) AS built FROM nation""")
def kept_stage(spark, sf_dir):
    """A stage asked for twice is built once; the second time it is read."""
    path, counter = scratch(spark, "stage"), itertools.count(1)

    def build() -> DataFrame:
        return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.lit(next(counter)).cast("long").alias("built"))

    kept(spark, path, build)
    return kept(spark, path, build)


def two_genes(contig: str, seq: str):
    """A toy gene finder: both halves of a sequence are genes."""
    half = len(seq) // 2
    for n, (a, b) in enumerate(((0, half), (half, len(seq))), 1):
        if b > a:
            yield f"{contig}_{n}", a + 1, b, 1 if n == 1 else -1, seq[a:b]


def by_length(proteins: list[tuple[str, str]]):
    """A toy profile search: a sequence's length is its score."""
    for name, seq in proteins:
        yield "KEGG", name, f"K{len(seq) % 10}", 1e-9, float(len(seq)), 100, 1, len(seq)


@query("""WITH h AS (SELECT doc_id, text, length(text) // 2 AS half, length(text) AS n FROM documents WHERE text IS NOT NULL), g AS (SELECT 'd_' || doc_id AS contig, 1 AS k, 1 AS a, half AS b, 1 AS frame FROM h WHERE half > 0 UNION ALL SELECT 'd_' || doc_id, 2, half + 1, n, -1 FROM h WHERE n > half)
SELECT contig, contig || '_' || k AS protein, CAST(k AS BIGINT) AS gene_number, CAST(a AS BIGINT) AS contig_pos_start, CAST(b AS BIGINT) AS contig_pos_end, frame, 'K' || ((b - a + 1) % 10) AS hmm_id, CAST(b - a + 1 AS DOUBLE) AS score FROM g""")
def plugged_in(spark, sf_dir):
    """A gene finder and a profile search from outside, run where the sequences are."""
    docs = table(spark, sf_dir, "documents").filter("text is not null").select(F.lit("f").alias("source_file"), F.lit(False).alias("is_vmag"), F.lit("").alias("genome"), F.concat(F.lit("d_"), F.col("doc_id").cast("string")).alias("name"), F.lit("").alias("description"), F.col("text").alias("seq"))
    proteins = plugins.predicted_proteins(docs, two_genes)
    found = plugins.searched(proteins, by_length).select(F.col("sequence").alias("protein"), "hmm_id", "score")
    return fasta.gene_index(proteins).join(found, "protein").select("contig", "protein", "gene_number", "contig_pos_start", "contig_pos_end", "frame", "hmm_id", "score")


@query(f"""WITH {LONG_SQL} SELECT 'hits' AS what, count(*) AS n FROM vb UNION ALL SELECT 'described', count(*) FROM vl WHERE de IS NOT NULL UNION ALL SELECT 'genes', count(*) FROM customer""")
def stage_counts(spark, sf_dir):
    """Rows by stage, as a run logs them."""
    found = versioned_hits(spark, sf_dir)
    rows = versioned_rows(spark, sf_dir)
    described = rows.select(F.explode(F.array(*[F.col(f"{p}_description") for p in LOWER])).alias("d")).filter("d is not null")
    parts = {"hits": found, "described": described, "genes": index_of(spark, sf_dir).dropDuplicates()}
    out = None
    for name, part in parts.items():
        own = part.agg(F.lit(name).alias("what"), F.count(F.lit(1)).alias("n"))
        out = own if out is None else out.unionByName(own)
    return out


@query(f"""WITH {GENES_SQL} SELECT contig, n, CAST(row_number() OVER (ORDER BY contig, n) AS BIGINT) AS place FROM genes""")
def annotation_order(spark, sf_dir):
    """The order of the annotation table by contig and gene, with places."""
    genes = genes_of(spark, sf_dir).select("contig", "n")
    return curate.with_places(genes.withColumn("key", F.col("contig") * 1_000_000 + F.col("n")), [], "key").select("contig", "n", "place")
