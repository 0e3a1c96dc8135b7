"""The operators as queries over the driver's tables, and their SQL.

A supplier stands for a contig and its line items for genes: a total order of all
columns numbers them, the quantity is the gene's length, and discount, tax and
price give scores with gaps.  SQL states each operator in another way than the
plan does: range self-joins for windows, unions of cases for arg-max, and so on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import keywords as kw
from ..functions import names, sequences
from ..operators import context, curate, hits, report, score
from ..operators import sequences as filters
from ..sources.fasta import gene_index

QUERIES, SQL = {}, {}

GENE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
GENES_SQL = f"""
genes AS (SELECT *, sum(len) OVER (PARTITION BY contig ORDER BY n) AS e, sum(len) OVER (PARTITION BY contig ORDER BY n) - len AS s FROM (
  SELECT l_suppkey AS contig, row_number() OVER (PARTITION BY l_suppkey ORDER BY {GENE_COLUMNS}) AS n, CAST(l_quantity AS BIGINT) AS len,
         l_partkey AS partkey, CASE WHEN l_discount >= 0.03 THEN l_discount * 100 END AS kegg, CASE WHEN l_tax >= 0.02 THEN l_tax * 100 END AS pfam,
         CASE WHEN l_returnflag <> 'R' THEN l_extendedprice / 9973 END AS phrog
  FROM lineitem))"""
WINDOW, FLANK = 300, 120


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(number):
    """Two decimals as SQL rounds them, by the hundredfold: 997.9 / 20 is 49.894999999999996 as a double, 4989.5 times a hundred; Spark's rounding takes the digits."""
    return F.round(number * 100, 0) / 100


def query(sql: str | None = None):
    """Registers a function as the query of its name, with its SQL."""

    def registered(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return registered


def genes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("l_suppkey").orderBy(*GENE_COLUMNS.split(", "))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("contig"), F.row_number().over(order).cast("long").alias("n"), F.col("l_quantity").cast("long").alias("len"), F.col("l_partkey").alias("partkey"),
        F.when(F.col("l_discount") >= 0.03, F.col("l_discount") * 100).alias("kegg"), F.when(F.col("l_tax") >= 0.02, F.col("l_tax") * 100).alias("pfam"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice") / 9973).alias("phrog"),
    )


SCORES = ("kegg", "pfam", "phrog")
PLACE = {"contig": ("contig",), "number": "n", "length": "len"}


@query(f"""WITH {GENES_SQL},
near AS (SELECT a.contig, a.n, b.* EXCLUDE (contig, n, s, e) FROM genes a JOIN genes b ON a.contig = b.contig
         AND ((b.n <= a.n AND a.s - b.s <= {WINDOW}) OR (b.n > a.n AND b.s - a.e < {WINDOW})))
SELECT contig, n, {', '.join(f"round(CASE WHEN count({c}) > 0 AND 100.0 * coalesce(sum(CASE WHEN {c} IS NOT NULL THEN len END), 0) / sum(len) >= 60 THEN avg({c}) END, 6) AS window_avg_{c}" for c in SCORES)}
FROM near GROUP BY contig, n""")
def window_mean(spark, sf_dir):
    """Means of the genes near each gene, where they cover 60 % of the window's length."""
    out = context.window_means(genes_of(spark, sf_dir), list(SCORES), WINDOW, 60.0, **PLACE)
    return out.select("contig", "n", *[F.round(f"window_avg_{c}", 6).alias(f"window_avg_{c}") for c in SCORES])


@query(f"""WITH {GENES_SQL}
SELECT a.contig, a.n, {', '.join(f"coalesce(bool_or(b.n < a.n AND a.s - b.s <= {FLANK} AND b.{c} >= {m}), false) AS {c}_flank_up, coalesce(bool_or(b.n > a.n AND b.s - a.e <= {FLANK} AND b.{c} >= {m}), false) AS {c}_flank_down" for c, m in (("kegg", 8), ("pfam", 8), ("phrog", 8)))}
FROM genes a JOIN genes b ON a.contig = b.contig AND abs(b.n - a.n) <= {FLANK} + 1 GROUP BY a.contig, a.n""")
def flank_flags(spark, sf_dir):
    """High scores upstream and downstream."""
    out = context.score_flanks(genes_of(spark, sf_dir), list(SCORES), FLANK, 8.0, **PLACE)
    return out.select("contig", "n", *[f"{c}_flank_{d}" for c in SCORES for d in ("up", "down")])


MOBILE_SQL = """SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#22', 'Brand#33')"""


@query(f"""WITH {GENES_SQL}, marked AS (SELECT g.*, g.partkey IN ({MOBILE_SQL}) AS m FROM genes g)
SELECT a.contig, a.n, bool_or(b.n < a.n AND a.s - b.s <= {FLANK} AND b.m) AS hallmark_flank_up, bool_or(b.n > a.n AND b.s - a.e <= {FLANK} AND b.m) AS hallmark_flank_down,
       bool_or(b.m AND ((b.n < a.n AND a.s - b.s <= {FLANK}) OR (b.n > a.n AND b.s - a.e <= {FLANK}))) AS mge_flank
FROM marked a JOIN marked b ON a.contig = b.contig AND abs(b.n - a.n) <= {FLANK} + 1 GROUP BY a.contig, a.n""")
def set_flank_flags(spark, sf_dir):
    """Members of an id set upstream, downstream, and on either side."""
    ids = table(spark, sf_dir, "part").filter(F.col("p_brand").isin("Brand#11", "Brand#22", "Brand#33")).select(F.col("p_partkey").alias("id"))
    genes = context.in_set(genes_of(spark, sf_dir), ids, "partkey", "marked")
    out = context.set_flanks(genes, {"hallmark": "marked"}, FLANK, **PLACE)
    return out.select("contig", "n", "hallmark_flank_up", "hallmark_flank_down", (F.col("hallmark_flank_up") | F.col("hallmark_flank_down")).alias("mge_flank"))


@query(f"""WITH {GENES_SQL}, m AS (SELECT contig, {', '.join(f'avg({c}) AS a_{c}' for c in SCORES)} FROM genes GROUP BY contig)
SELECT contig, n, {', '.join(f'round(a_{c}, 6) AS contig_avg_{c}' for c in SCORES)} FROM genes JOIN m USING (contig)""")
def contig_stats(spark, sf_dir):
    """Means over whole contigs."""
    out = context.contig_means(genes_of(spark, sf_dir), list(SCORES), ("contig",))
    return out.select("contig", "n", *[F.round(f"contig_avg_{c}", 6).alias(f"contig_avg_{c}") for c in SCORES])


@query(f"""WITH {GENES_SQL}, m AS (SELECT contig, median(kegg) AS mk, median(phrog) AS mp FROM genes GROUP BY contig)
SELECT contig, n, round(coalesce(kegg, mk), 6) AS kegg, round(coalesce(phrog, mp), 6) AS phrog, 0.0::DOUBLE AS absent FROM genes JOIN m USING (contig)""")
def impute_median(spark, sf_dir):
    """Missing numbers filled by the contig's median; absent features are 0."""
    out = score.imputed(genes_of(spark, sf_dir), ["kegg", "phrog", "absent"], ("contig",))
    return out.select("contig", "n", *[F.round(f"_f_{c}", 6).alias(c) for c in ("kegg", "phrog", "absent")])


@query(f"""WITH {GENES_SQL}, f AS (SELECT contig, n, CASE WHEN kegg IS NOT NULL THEN pfam >= 5 END AS flank FROM genes),
c AS (SELECT contig, flank, count(*) AS k FROM f WHERE flank IS NOT NULL GROUP BY contig, flank),
m AS (SELECT contig, flank AS mode FROM (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY k DESC, flank) AS r FROM c) WHERE r = 1)
SELECT contig, n, CAST(CAST(coalesce(f.flank, m.mode, false) AS INTEGER) AS DOUBLE) AS flank FROM f LEFT JOIN m USING (contig)""")
def impute_mode(spark, sf_dir):
    """Missing flags filled by the contig's mode."""
    genes = genes_of(spark, sf_dir).withColumn("flank", F.when(F.col("kegg").isNotNull(), F.col("pfam") >= 5))
    return score.imputed(genes, ["flank"], ("contig",)).select("contig", "n", F.col("_f_flank").alias("flank"))


@query(f"""WITH {GENES_SQL}, p AS (SELECT contig, n, 1 / (1 + exp(-(-3 + 0.4 * coalesce(kegg, 0) + 0.3 * coalesce(pfam, 0)))) AS p FROM genes)
SELECT contig, n, round(p, 6) AS viral_prob, CASE WHEN p >= 0.8 THEN 'high' WHEN p >= 0.5 THEN 'medium' ELSE 'low' END AS viral_origin_confidence FROM p""")
def confidence_bucket(spark, sf_dir):
    """The rule scorer's probability and its label."""
    out = score.scored(genes_of(spark, sf_dir), score.RuleScorer({"kegg": 0.4, "pfam": 0.3}, -3.0), ("contig",))
    return out.select("contig", "n", F.round("viral_prob", 6).alias("viral_prob"), "viral_origin_confidence")


@query("SELECT doc_id, length(text) AS n FROM documents WHERE length(text) >= 1500")
def seq_length_filter(spark, sf_dir):
    """Sequences of a least length."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("seq"))
    return filters.long_enough(docs, 1500).select("doc_id", F.length("seq").cast("long").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, n FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE n >= 4""")
def cds_count_filter(spark, sf_dir):
    """Proteins of contigs with enough of them."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.lit("f").alias("source_file"), F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("name"))
    kept = filters.enough_genes(rows, 4)
    return kept.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey"))).select("l_orderkey", "l_linenumber", "l_partkey", "n")


@query("""SELECT count(DISTINCT source) AS n_genomes, count(DISTINCT lang) AS n_contigs, count(*) AS n_proteins, CAST(sum(length(text)) AS BIGINT) AS n_residues FROM documents""")
def sequence_totals(spark, sf_dir):
    """Genomes, contigs, proteins and residues."""
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("genome"), F.concat_ws("_", "lang", F.col("doc_id").cast("string")).alias("name"), F.col("text").alias("seq"))
    return filters.totals(rows)


HITS_SQL = """
raw AS (SELECT CASE l_linenumber % 7 WHEN 0 THEN 'KEGG' WHEN 1 THEN 'FOAM' WHEN 2 THEN 'Pfam' WHEN 3 THEN 'dbCAN' WHEN 4 THEN 'METABOLIC' ELSE 'PHROG' END AS db,
  l_suppkey AS sequence, 'H' || (l_partkey % 50) AS hmm_id, power(10.0, -l_quantity) AS evalue, round(l_extendedprice / 499, 2) AS score, 100 AS length, 1 AS "start", 20 + l_partkey % 80 AS "end", l_orderkey, l_linenumber FROM lineitem),
cuts AS (SELECT d.db, 'H' || (p_partkey % 50) AS hmm_id, max(round(p_retailprice / 20, 2)) AS cut FROM part, (VALUES ('KEGG'), ('FOAM'), ('Pfam'), ('METABOLIC')) d(db) WHERE p_partkey % 3 = 0 AND p_partkey % 50 < 30 GROUP BY 1, 2),
ok AS (SELECT r.*, ("end" - "start" + 1) / 100.0 AS cov FROM raw r LEFT JOIN cuts c ON r.db = c.db AND r.hmm_id = c.hmm_id
  WHERE CASE WHEN cut IS NOT NULL AND r.db IN ('Pfam', 'METABOLIC') THEN score >= cut
             WHEN cut IS NOT NULL AND r.db IN ('KEGG', 'FOAM') THEN score >= cut OR (evalue <= 1e-5 AND score >= 0.5 * cut)
             ELSE score >= 50 AND ("end" - "start" + 1) / 100.0 >= 0.5 END)"""


def raw_hits_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    line = F.col("l_linenumber") % 7
    db = F.when(line == 0, "KEGG").when(line == 1, "FOAM").when(line == 2, "Pfam").when(line == 3, "dbCAN").when(line == 4, "METABOLIC").otherwise("PHROG")
    part = lambda c: F.concat(F.lit("H"), (F.col(c) % 50).cast("string"))
    raw = table(spark, sf_dir, "lineitem").select(
        db.alias("db"), F.col("l_suppkey").alias("sequence"), part("l_partkey").alias("hmm_id"), F.pow(F.lit(10.0), -F.col("l_quantity")).alias("evalue"), cents(F.col("l_extendedprice") / 499).alias("score"),
        F.lit(100).alias("length"), F.lit(1).alias("start"), (20 + F.col("l_partkey") % 80).alias("end"), "l_orderkey", "l_linenumber",
    )
    parts = table(spark, sf_dir, "part").filter("p_partkey % 3 = 0 and p_partkey % 50 < 30")
    cuts = parts.select(F.explode(F.array(*[F.lit(x) for x in ("KEGG", "FOAM", "Pfam", "METABOLIC")])).alias("db"), part("p_partkey").alias("hmm_id"), cents(F.col("p_retailprice") / 20).alias("value"))
    return raw, cuts


@query(f"WITH {HITS_SQL} SELECT db, sequence, hmm_id, score, round(cov, 3) AS hmm_coverage, l_orderkey, l_linenumber FROM ok")
def hit_acceptance(spark, sf_dir):
    """Hits that pass their database's rule."""
    raw, cuts = raw_hits_of(spark, sf_dir)
    return hits.accepted(raw, cuts, EngineConfig()).select("db", "sequence", "hmm_id", "score", F.round("hmm_coverage", 3).alias("hmm_coverage"), "l_orderkey", "l_linenumber")


BEST_SQL = f"""{HITS_SQL}, best AS (SELECT db, sequence, hmm_id, score, round(cov, 3) AS hmm_coverage FROM
  (SELECT *, row_number() OVER (PARTITION BY db, sequence ORDER BY evalue, score DESC, hmm_id, "start", "end") AS r FROM ok) WHERE r = 1)"""


def best_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, cuts = raw_hits_of(spark, sf_dir)
    return hits.best_hits(hits.accepted(raw, cuts, EngineConfig()))


@query(f"WITH {BEST_SQL} SELECT * FROM best")
def best_hit(spark, sf_dir):
    """The best hit of each database and protein."""
    return best_of(spark, sf_dir)


@query("WITH " + BEST_SQL + " SELECT sequence, " + ", ".join(f"max({c}) FILTER (db = '{db}') AS {db.lower()}_{t}" for db in ("KEGG", "FOAM", "Pfam", "dbCAN", "METABOLIC", "PHROG") for c, t in (("score", "score"), ("hmm_id", "hmm_id"), ("hmm_coverage", "coverage"))) + " FROM best GROUP BY sequence")
def pivot_hits(spark, sf_dir):
    """Hits of all databases side by side."""
    return hits.pivoted(best_of(spark, sf_dir))


VSCORES_SQL = """v AS (SELECT 'H' || k AS id, k * 0.25 AS v_score, k * 0.5 AS vl_score FROM (SELECT DISTINCT p_partkey % 50 AS k FROM part) WHERE k % 4 <> 0),
  sc AS (SELECT b.*, v_score, vl_score FROM best b JOIN v ON v.id = b.hmm_id WHERE db IN ('KEGG', 'Pfam', 'PHROG'))"""
WIDE_SQL = ", ".join(f"{db.lower()}.hmm_coverage AS {db.lower()}_hmm_coverage, {db.lower()}.v_score AS {db.lower()}_v_score, {db.lower()}.vl_score AS {db.lower()}_vl_score" for db in ("KEGG", "Pfam", "PHROG"))


def scored_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    v = table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).alias("k")).distinct().filter("k % 4 <> 0")
    v = v.select(F.concat(F.lit("H"), k.cast("string")).alias("id"), (k * 0.25).alias("v_score"), (k * 0.5).alias("vl_score"), F.lit("KEGG").alias("db"))
    return hits.with_vscores(best_of(spark, sf_dir).filter(F.col("db").isin("KEGG", "Pfam", "PHROG")), v)


@query(f"""WITH {BEST_SQL}, {VSCORES_SQL}, k AS (SELECT DISTINCT sequence FROM sc)
SELECT k.sequence, {WIDE_SQL} FROM k LEFT JOIN (FROM sc WHERE db = 'KEGG') kegg USING (sequence) LEFT JOIN (FROM sc WHERE db = 'Pfam') pfam USING (sequence) LEFT JOIN (FROM sc WHERE db = 'PHROG') phrog USING (sequence)""")
def vscore_outer(spark, sf_dir):
    """Virus scores of three databases side by side."""
    return hits.wide_vscores(scored_hits(spark, sf_dir))


@query(f"""WITH {BEST_SQL}, {VSCORES_SQL}, j AS (SELECT pfam.sequence, {WIDE_SQL} FROM (FROM sc WHERE db = 'Pfam') pfam FULL JOIN (FROM sc WHERE db = 'KEGG') kegg ON pfam.sequence = kegg.sequence FULL JOIN (FROM sc WHERE db = 'PHROG') phrog ON pfam.sequence = phrog.sequence)
SELECT * FROM j WHERE sequence IS NOT NULL""")
def vscore_outer_compat(spark, sf_dir):
    """As the original: scores survive only beside a Pfam score."""
    return hits.wide_vscores(scored_hits(spark, sf_dir), compat=True)


DESC_SQL = """, n AS (SELECT 'H' || k AS id, CASE WHEN k % 2 = 0 THEN 'Pfam' ELSE 'KEGG' END AS db, 'name of ' || k AS name FROM (SELECT DISTINCT p_partkey % 50 AS k FROM part) WHERE k % 5 <> 0),
  w AS (SELECT sequence, """ + ", ".join(f"max(score) FILTER (db = '{db}') AS {db.lower()}_score, max(hmm_id) FILTER (db = '{db}') AS {db.lower()}_hmm_id" for db in ("KEGG", "FOAM", "Pfam", "dbCAN", "METABOLIC", "PHROG")) + """ FROM best GROUP BY sequence),
  d AS (SELECT w.*, """ + ", ".join(f"(SELECT min(name) FROM n WHERE n.id = w.{db.lower()}_hmm_id{' AND n.db = ' + chr(39) + 'Pfam' + chr(39) if db == 'Pfam' else ''}) AS {db.lower()}_description" for db in ("KEGG", "FOAM", "Pfam", "dbCAN", "METABOLIC", "PHROG")) + " FROM w)"


def described_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    n = table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).alias("k")).distinct().filter("k % 5 <> 0")
    n = n.select(F.concat(F.lit("H"), k.cast("string")).alias("id"), F.when(k % 2 == 0, "Pfam").otherwise("KEGG").alias("db"), F.concat(F.lit("name of "), k.cast("string")).alias("name"))
    return curate.described(hits.pivoted(best_of(spark, sf_dir)), n)


@query(f"WITH {BEST_SQL}{DESC_SQL} SELECT sequence, {', '.join(f'{p}_hmm_id, {p}_description' for p in ('kegg', 'foam', 'pfam', 'dbcan', 'metabolic', 'phrog'))} FROM d")
def desc_joins(spark, sf_dir):
    """Descriptions of every database's hit."""
    return described_hits(spark, sf_dir).select("sequence", *[f"{p}_{c}" for p in ("kegg", "foam", "pfam", "dbcan", "metabolic", "phrog") for c in ("hmm_id", "description")])


@query(f"""WITH {BEST_SQL}{DESC_SQL}, u AS ({' UNION ALL '.join(f"SELECT sequence, {k} AS p, '{db}' AS db, {db.lower()}_score AS s, {db.lower()}_hmm_id AS id, {db.lower()}_description AS de FROM d" for k, db in enumerate(("KEGG", "FOAM", "Pfam", "dbCAN", "METABOLIC", "PHROG")))})
SELECT sequence, id AS top_hit_hmm_id, de AS top_hit_description, db AS top_hit_db FROM (SELECT *, row_number() OVER (PARTITION BY sequence ORDER BY s DESC NULLS LAST, p) AS r FROM u WHERE s IS NOT NULL) WHERE r = 1""")
def top_hit(spark, sf_dir):
    """The highest score of all databases; ties to the first."""
    return described_hits(spark, sf_dir).select("sequence", *curate.top_hit())


HARD, SOFT = ["oner", "thaou", "EC 1.2.3.4"], ["ingth", "leaux"]
CASES = " OR ".join(f"contains(lower(text), '{w.lower()}')" for w in HARD)


@query(f"SELECT doc_id, lang FROM documents WHERE text IS NULL OR NOT ({CASES})")
def keyword_hard(spark, sf_dir):
    """Texts without any hard keyword, by one alternation."""
    docs = table(spark, sf_dir, "documents")
    return docs.filter(~kw.matches(F.col("text"), kw.any_of(HARD))).select("doc_id", "lang")


@query(f"""SELECT doc_id, lang FROM documents WHERE NOT coalesce({" OR ".join(f"contains(lower(text), '{w}')" for w in SOFT)}, false)
  OR (coalesce({" OR ".join(f"contains(lower(text), '{w}')" for w in SOFT)}, false) AND n_chars >= 2000 AND source IN (SELECT DISTINCT source FROM documents WHERE lang = 'es'))""")
def keyword_soft(spark, sf_dir):
    """Texts without soft keywords, or rescued by their length and source."""
    docs = table(spark, sf_dir, "documents")
    ids = docs.filter("lang = 'es'").select(F.col("source").alias("id"))
    rows = context.in_set(docs, ids, "source", "in_class")
    soft = kw.matches(F.col("text"), kw.any_of(SOFT))
    return rows.filter(~soft | ((F.col("n_chars") >= 2000) & F.col("in_class"))).select("doc_id", "lang")


@query(f"""WITH {BEST_SQL}{DESC_SQL}, c AS (SELECT 'H' || k AS id FROM (SELECT DISTINCT p_partkey % 50 AS k FROM part) WHERE k % 7 = 0)
SELECT sequence FROM d WHERE {' OR '.join(f'{p}_hmm_id IN (SELECT id FROM c)' for p in ('kegg', 'foam', 'pfam', 'dbcan', 'metabolic', 'phrog'))}""")
def class_semi(spark, sf_dir):
    """Proteins with an id of any database in a class list."""
    ids = table(spark, sf_dir, "part").filter("p_partkey % 50 % 7 = 0").select(F.concat(F.lit("H"), (F.col("p_partkey") % 50).cast("string")).alias("id"))
    return curate.class_members(hits.pivoted(best_of(spark, sf_dir)), ids).select("sequence")


@query("""WITH a AS (SELECT doc_id FROM labels WHERE toxic = 1), b AS (SELECT doc_id FROM labels WHERE quality = 1), c AS (SELECT doc_id FROM documents WHERE lang = 'fr')
SELECT doc_id, CASE WHEN doc_id IN (FROM a) THEN 'metabolic' WHEN doc_id IN (FROM b) THEN 'physiological' WHEN doc_id IN (FROM c) THEN 'regulatory' ELSE 'unclassified' END AS classification FROM documents""")
def classify_priority(spark, sf_dir):
    """The first of three classes that has the id."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    members = {"metabolic": labels.filter("toxic = 1"), "physiological": labels.filter("quality = 1"), "regulatory": docs.filter("lang = 'fr'")}
    return curate.classified(docs.select("doc_id"), members, "doc_id").select("doc_id", "classification")


@query("""SELECT p_partkey, round((length(p_name) - 2) * 1.0 / len(list_distinct([substr(p_name, i, 3) FOR i IN range(1, length(p_name) - 1)])), 6) AS multiplicity FROM part WHERE length(p_name) >= 3
UNION ALL SELECT p_partkey, NULL FROM part WHERE length(p_name) < 3""")
def kmer_multiplicity(spark, sf_dir):
    """All 3-mers of a name by distinct ones."""
    return table(spark, sf_dir, "part").select("p_partkey", F.round(sequences.kmer_multiplicity(F.col("p_name"), 3), 6).alias("multiplicity"))


@query("""WITH s AS (SELECT doc_id, translate(upper(regexp_replace(text, '[^a-zA-Z]', '', 'g')), 'EIO', 'CGT') AS seq FROM documents) SELECT doc_id, md5(reverse(translate(seq, 'ACTG', 'TGAC'))) AS digest FROM s""")
def revcomp(spark, sf_dir):
    """Reverse complements."""
    seq = F.translate(F.upper(F.regexp_replace("text", "[^a-zA-Z]", "")), "EIO", "CGT")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(sequences.reverse_complement(seq).cast("binary")).alias("digest"))


@query("""WITH b AS (SELECT p_partkey, upper(substr(md5(p_name), 1, 24)) AS h, upper(md5(p_type)) AS m FROM part),
q AS (SELECT p_partkey, translate(h, '0123456789BDEF', 'ACGTACGTACGTAC') AS t, translate(m, '0123456789BDEF', 'ACGTACGTACGTAC') AS x, p_partkey % 3 AS k FROM b)
SELECT p_partkey, CASE WHEN k = 2 THEN NULL WHEN k = 1 THEN 'ITR' ELSE 'DTR' END AS kind, CASE WHEN k = 2 THEN '' ELSE t END AS repeat FROM q""")
def terminal_repeat(spark, sf_dir):
    """Direct and inverted repeats built into sequences are found, and no others."""
    code = lambda c: F.translate(c, "0123456789BDEF", "ACGTACGTACGTAC")
    t, x, k = code(F.upper(F.substring(F.md5(F.col("p_name").cast("binary")), 1, 24))), code(F.upper(F.md5(F.col("p_type").cast("binary")))), F.col("p_partkey") % 3
    # The middle ends in letters that stop an inverted repeat after 24 bases.
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(k == 0, F.concat(t, F.lit("N"), x, t)).when(k == 1, F.concat(t, F.lit("N"), x, F.lit("R"), sequences.reverse_complement(t))).otherwise(F.concat(F.lit("N"), x, t, F.lit("R"))).alias("seq"))
    d, i = sequences.direct_repeat(F.col("seq")), sequences.inverted_repeat(F.col("seq"))
    found = rows.select("p_partkey", d.alias("d"), i.alias("i"))
    kind = F.when((F.length("d") < 20) & (F.length("i") < 20), F.lit(None).cast("string")).when(F.length("d") >= F.length("i"), "DTR").otherwise("ITR")
    return found.select("p_partkey", kind.alias("kind"), F.when(kind == "DTR", F.col("d")).when(kind == "ITR", F.col("i")).otherwise("").alias("repeat"))


@query("""SELECT 'c_' || l_suppkey AS genome, 'c_' || l_suppkey AS contig, 'c_' || l_suppkey || '_' || l_linenumber AS protein, CAST(l_linenumber AS BIGINT) AS gene_number, l_orderkey AS contig_pos_start, l_orderkey + l_partkey AS contig_pos_end, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS frame FROM lineitem""")
def fasta_headers(spark, sf_dir):
    """The gene index from protein headers."""
    s = lambda c: F.col(c).cast("string")
    name = F.concat(F.lit("c_"), s("l_suppkey"), F.lit("_"), s("l_linenumber"))
    text = F.concat(F.lit("# "), s("l_orderkey"), F.lit(" # "), (F.col("l_orderkey") + F.col("l_partkey")).cast("string"), F.lit(" # "), F.when(F.col("l_returnflag") == "R", "-1").otherwise("1"), F.lit(" # ID=1_1;partial=00"))
    return gene_index(table(spark, sf_dir, "lineitem").select(name.alias("name"), text.alias("description"), F.lit(False).alias("is_vmag"), F.lit("").alias("genome"))).drop("is_vmag")


@query("""SELECT s_name AS name, s_nationkey AS nation FROM supplier UNION SELECT c_name, c_nationkey FROM customer UNION SELECT 'total', (SELECT count(*) FROM (SELECT s_nationkey FROM supplier UNION ALL SELECT c_nationkey FROM customer))""")
def union_distinct(spark, sf_dir):
    """Distinct rows of two tables, and the number of all."""
    a = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").cast("long").alias("nation"))
    b = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").cast("long").alias("nation"))
    both = a.unionByName(b)
    return both.dropDuplicates().unionByName(both.agg(F.lit("total").alias("name"), F.count(F.lit(1)).alias("nation")))


@query("""SELECT CASE WHEN toxic = 1 THEN 'metabolic' ELSE 'unclassified' END AS classification, CASE quality WHEN 1 THEN 'high' ELSE 'low' END AS viral_origin_confidence, count(DISTINCT doc_id) AS n_proteins FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2""")
def category_counts(spark, sf_dir):
    """Distinct proteins by class and confidence; none counts as low."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    rows = rows.select(F.col("doc_id").alias("protein"), F.when(F.col("toxic") == 1, "metabolic").otherwise("unclassified").alias("classification"), F.when(F.col("quality") == 1, "high").alias("viral_origin_confidence"))
    return report.category_counts(rows)


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'PF' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') WHEN 1 THEN 'COG' || p_partkey WHEN 2 THEN 'K' || p_partkey WHEN 3 THEN 'GH' || p_partkey ELSE 'x' || p_partkey END AS hmm_id,
CASE p_partkey % 5 WHEN 0 THEN 'Pfam' WHEN 1 THEN 'eggNOG' WHEN 2 THEN 'KEGG' WHEN 3 THEN 'dbCAN' ELSE NULL END AS db FROM part""")
def hmm_names(spark, sf_dir):
    """Profile ids and databases from names and files."""
    k, n = F.col("p_partkey") % 5, F.col("p_partkey").cast("string")
    path = F.when(k == 0, "/db/Pfam-A.h3m").when(k == 1, "/kegg/eggNOG.h3m").when(k == 2, "/db/kofam.h3m").when(k == 3, "/db/dbCAN.h3m").otherwise("/kegg/other.h3m")
    name = F.when(k == 1, F.concat(F.lit("COG"), n, F.lit(".faa.final"))).when(k == 2, F.concat(F.lit("K"), n, F.lit(".hmm"))).when(k == 3, F.concat(F.lit("a.GH"), n, F.lit(".wlink.txt.mafft"))).otherwise(F.concat(F.lit("x"), n, F.lit("_alignment")))
    accession = F.concat(F.lit("PF"), F.lpad(n, 5, "0"), F.lit(".7"))
    db = names.database_of(path)
    found = names.hmm_id_of(F.coalesce(db, F.lit("")), name, accession)
    return table(spark, sf_dir, "part").select("p_partkey", names.strip_version(found).alias("hmm_id"), db.alias("db"))


@query("""SELECT l_suppkey AS contig, l_linenumber, l_shipdate, l_orderkey, l_partkey, l_quantity, CAST(l_orderkey + 3 * l_partkey - l_orderkey + 1 AS BIGINT) AS gene_length_bases, CAST(floor((3 * l_partkey + 1) / 3.0) AS INTEGER) AS prot_length_aas FROM lineitem""")
def gene_lengths(spark, sf_dir):
    """Lengths in bases and in amino acids."""
    rows = table(spark, sf_dir, "lineitem").withColumn("contig_pos_start", F.col("l_orderkey")).withColumn("contig_pos_end", F.col("l_orderkey") + 3 * F.col("l_partkey"))
    return context.gene_lengths(rows).select(F.col("l_suppkey").alias("contig"), "l_linenumber", "l_shipdate", "l_orderkey", "l_partkey", "l_quantity", "gene_length_bases", "prot_length_aas")


@query("""WITH r AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k, event_id FROM events) SELECT event_id, CASE WHEN k = 1 THEN event_type ELSE event_type || '_' || k END AS name FROM r""")
def unique_names(spark, sf_dir):
    """Repeated names numbered."""
    return filters.unique_names(table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("name")), "name", "event_id")


NAMES = ("kegg", "foam", "pfam", "dbcan", "metabolic", "phrog")
FALLBACK = ("dbcan", "kegg", "foam", "metabolic", "pfam")
TOP_SQL = f"""u AS ({' UNION ALL '.join(f"SELECT sequence, {k} AS p, '{db}' AS db, {db.lower()}_score AS s, {db.lower()}_hmm_id AS id, {db.lower()}_description AS de FROM d" for k, db in enumerate(("KEGG", "FOAM", "Pfam", "dbCAN", "METABOLIC", "PHROG")))}),
  t AS (SELECT sequence, id, de, db FROM (SELECT *, row_number() OVER (PARTITION BY sequence ORDER BY s DESC NULLS LAST, p) AS r FROM u WHERE s IS NOT NULL) WHERE r = 1)"""


@query(f"""WITH {BEST_SQL}{DESC_SQL}, {TOP_SQL}
SELECT sequence, CASE WHEN t.db = 'PHROG' THEN coalesce({', '.join(f"'\"' || {p}_hmm_id || ' ' || {p}_description || '\"'" for p in FALLBACK)}, '')
  ELSE '"' || id || coalesce(' ' || de, '') || '"' END AS description FROM d JOIN t USING (sequence)""")
def header_descriptions(spark, sf_dir):
    """What stands behind a protein's name in its sequence file."""
    rows = described_hits(spark, sf_dir)
    rows = rows.select("*", *curate.top_hit())
    return rows.select("sequence", report.header_description().alias("description"))


@query("""WITH m AS (SELECT doc_id, 'metabolic' AS category, CASE quality WHEN 1 THEN 'high' WHEN 0 THEN 'medium' ELSE 'low' END AS c FROM labels WHERE toxic = 1
UNION ALL SELECT doc_id, 'physiological', CASE quality WHEN 1 THEN 'high' WHEN 0 THEN 'medium' ELSE 'low' END FROM labels WHERE toxic = 0),
r AS (SELECT DISTINCT category, c, m.doc_id, d.n_chars FROM m JOIN documents d USING (doc_id))
SELECT category, c AS confidence, doc_id, n_chars FROM r UNION ALL SELECT category, 'all', doc_id, n_chars FROM r""")
def category_sequences(spark, sf_dir):
    """Sequences of each class by confidence, and all of them."""
    labels = table(spark, sf_dir, "labels").withColumn("viral_origin_confidence", F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "medium")).withColumnRenamed("doc_id", "protein")
    labels = labels.withColumns({c: F.lit(None).cast("string") for c in ("top_hit_hmm_id", "top_hit_description", "top_hit_db", *[f"{p}_{x}" for p in FALLBACK for x in ("hmm_id", "description")])})
    proteins = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), F.col("n_chars").alias("seq"))
    found = report.category_sequences({"metabolic": labels.filter("toxic = 1"), "physiological": labels.filter("toxic = 0")}, proteins)
    return found.select("category", "confidence", F.col("name").alias("doc_id"), F.col("seq").alias("n_chars"))


@query("""SELECT 'metabolic' AS category, doc_id AS name FROM documents WHERE lang = 'fr' AND doc_id NOT IN (SELECT doc_id FROM labels)""")
def missing_sequences(spark, sf_dir):
    """Proteins of a class without a record."""
    docs = table(spark, sf_dir, "documents").filter("lang = 'fr'").select(F.col("doc_id").alias("protein"))
    return report.missing_sequences({"metabolic": docs}, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("name")))


@query("""SELECT l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY l_returnflag""")
def value_counts(spark, sf_dir):
    """Rows by value."""
    return report.value_counts(table(spark, sf_dir, "lineitem"), "l_returnflag")


@query(f"""WITH {GENES_SQL} SELECT contig, n, coalesce(kegg >= 8, false) OR coalesce(pfam >= 8, false) OR coalesce(phrog >= 8, false) AS flag FROM genes""")
def any_flags(spark, sf_dir):
    """Or of flags with gaps."""
    genes = genes_of(spark, sf_dir).withColumns({f"{c}_flag": F.col(c) >= 8 for c in SCORES})
    return genes.select("contig", "n", curate.any_flag(*[f"{c}_flag" for c in SCORES]).alias("flag"))


@query("""SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\s\\x0B]', '', 'g') AS seq, coalesce('lang ' || lang, '') AS description FROM documents""")
def fasta_records(spark, sf_dir):
    """The texts of all documents written as FASTA and parsed again: names, descriptions, joined sequence lines."""
    from ..sources.fasta import parsed_records
    from ..sources.sinks import fasta_record

    docs = table(spark, sf_dir, "documents")
    written = docs.select(fasta_record(F.col("doc_id").cast("string"), F.concat(F.lit("lang "), "lang"), F.coalesce("text", F.lit(""))).alias("record"))
    return parsed_records(written, F.lit("f.fa"), False).select(F.col("name").cast("long").alias("doc_id"), "seq", "description")


@query("""SELECT o_orderkey, o_orderstatus, o_orderpriority, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END, o_orderkey) AS place FROM orders""")
def rank_sort(spark, sf_dir):
    """All rows by two ranked columns and a key, with their places."""
    ranked = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", curate.rank_of("o_orderstatus", ("O", "F")).alias("a"), curate.rank_of("o_orderpriority", ("1-URGENT", "2-HIGH")).alias("b"))
    return curate.with_places(ranked, ["a", "b"], "o_orderkey").drop("a", "b")
