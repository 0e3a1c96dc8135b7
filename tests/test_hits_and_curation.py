import pytest
from pyspark.sql import functions as F

from virelay import schemas
from virelay.config import DATABASES, EngineConfig
from virelay.functions import keywords as kw
from virelay.operators import curate, hits, report, score


def test_acceptance_rules(spark):
    rows = [
        ("Pfam", "a", "P1", 1e-9, 30.0, 100, 1, 10), ("Pfam", "b", "P1", 1e-9, 29.0, 100, 1, 100),
        ("KEGG", "a", "K1", 1e-4, 100.0, 100, 1, 10), ("KEGG", "b", "K1", 1e-5, 50.0, 100, 1, 10), ("KEGG", "c", "K1", 1e-4, 99.0, 100, 1, 100), ("KEGG", "d", "K1", 1e-5, 49.0, 100, 1, 100),
        ("KEGG", "e", "K2", 1.0, 50.0, 100, 1, 50), ("KEGG", "f", "K2", 1.0, 50.0, 100, 1, 49), ("PHROG", "g", "x", 1.0, 49.0, 100, 1, 100), ("PHROG", "h", "x", 1.0, None, 0, 1, 100),
    ]
    cut = spark.createDataFrame([("Pfam", "P1", 30.0), ("KEGG", "K1", 100.0)], schemas.THRESHOLDS)
    got = hits.accepted(spark.createDataFrame(rows, schemas.HITS_RAW), cut, EngineConfig()).collect()
    assert sorted((r.db, r.sequence) for r in got) == [("KEGG", "a"), ("KEGG", "b"), ("KEGG", "e"), ("Pfam", "a")]


def test_best_hit_ties_and_rounding(spark):
    rows = [("KEGG", "s", "K1", 1.04e-9, 60.0, 100, 1, 80), ("KEGG", "s", "K2", 1.01e-9, 50.0, 100, 1, 80), ("KEGG", "t", "K4", 1e-9, 50.0, 100, 1, 80), ("KEGG", "t", "K3", 1e-9, 50.0, 100, 1, 80)]
    ok = hits.accepted(spark.createDataFrame(rows, schemas.HITS_RAW), spark.createDataFrame([], schemas.THRESHOLDS), EngineConfig())
    assert {r.sequence: r.hmm_id for r in hits.best_hits(ok).collect()} == {"s": "K2", "t": "K3"}
    assert {r.sequence: r.hmm_id for r in hits.best_hits(ok, compat=True).collect()} == {"s": "K1", "t": "K3"}


def test_virus_scores_and_their_loss_in_compat(spark):
    best = spark.createDataFrame([("KEGG", "s", "K1", 1.0, 0.5), ("Pfam", "t", "PF1.7", 1.0, 0.5), ("KEGG", "t", "K1", 1.0, 0.5), ("KEGG", "u", "K9", 1.0, 0.5)], schemas.HITS_BEST)
    v = spark.createDataFrame([("K1", 3.0, 4.0, "KEGG", ""), ("PF1.2", 5.0, 6.0, "Pfam", ""), ("K9", None, 1.0, "KEGG", "")], schemas.VSCORES)
    scored = hits.with_vscores(best, v)
    assert {r.sequence: (r.kegg_v_score, r.pfam_v_score) for r in hits.wide_vscores(scored).collect()} == {"s": (3.0, None), "t": (3.0, 5.0)}
    assert [r.sequence for r in hits.wide_vscores(scored, compat=True).collect()] == ["t"]


def wide(spark, **values):
    base = {"protein": "p"}
    for db in DATABASES:
        base |= {f"{db.lower()}_{c}": None for c in ("hmm_id", "description", "score", "coverage")}
    kinds = ", ".join(f"{k} {'double' if k.endswith(('score', 'coverage')) else 'string'}" for k in base)
    return spark.createDataFrame([tuple((base | values).values())], kinds)


def test_top_hit(spark):
    tie = wide(spark, foam_score=5.0, foam_hmm_id="F", kegg_score=5.0, kegg_hmm_id="K", phrog_score=4.0)
    assert tie.select(*curate.top_hit()).first()["top_hit_hmm_id"] == "K"
    assert tuple(wide(spark).select(*curate.top_hit()).first()) == (None, None, None)
    assert tuple(wide(spark).select(*curate.top_hit(compat=True)).first()) == (None, None, "KEGG")


@pytest.mark.parametrize("values,stays", [
    ({"kegg_description": "a Hard one"}, False),
    ({"kegg_description": "soft", "kegg_hmm_id": "K1", "kegg_score": 200.0, "kegg_coverage": 0.9}, True),
    ({"kegg_description": "soft", "kegg_hmm_id": "K1", "kegg_score": 74.0, "kegg_coverage": 0.9}, False),
    ({"kegg_description": "soft", "kegg_hmm_id": "K2", "kegg_score": 30.0, "kegg_coverage": 0.75}, True),
    ({"kegg_description": "soft", "kegg_hmm_id": "K2", "kegg_score": 30.0, "kegg_coverage": 0.74}, False),
    ({"kegg_description": "soft", "kegg_hmm_id": "K9", "kegg_score": 900.0, "kegg_coverage": 1.0}, False),
    ({"kegg_description": "soft", "foam_description": "soft", "foam_hmm_id": "K1", "foam_score": 75.0, "foam_coverage": 0.8}, True),
    ({"kegg_description": "soft hard", "kegg_hmm_id": "K1", "kegg_score": 200.0, "kegg_coverage": 0.9}, False),
    ({"kegg_description": None}, True),
])
def test_keyword_rules(spark, values, stays):
    ids = spark.createDataFrame([("K1",), ("K2",)], "id string")
    cut = spark.createDataFrame([("KEGG", "K2", 25.0)], schemas.THRESHOLDS)
    got = curate.without_keywords(wide(spark, **values), ["hard"], ["soft"], ids, cut, EngineConfig())
    assert (got.count() == 1) is stays


def test_keyword_patterns(spark):
    rule = kw.any_of(["lysin", "EC 1.2.3.4", "EC 2.3.", "a+b"])
    texts = {"an endolysin": False, "a Lysin,": True, "x EC:1.2.3.4]": True, "EC 1.2.3.45": False, "ec 2.3.9.1": True, "A+B": True, "aab": False, None: False}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", kw.matches(F.col("t"), rule).alias("m"))
    assert {r.t: r.m for r in df.collect()} == texts


def test_class_membership(spark):
    ids = spark.createDataFrame([("PF1",), ("GH1",)], "id string")
    assert curate.class_members(wide(spark, pfam_hmm_id="PF1.3"), ids).count() == 1
    assert curate.class_members(wide(spark, dbcan_hmm_id="GH1_4"), ids).count() == 0
    assert curate.class_members(wide(spark), ids).count() == 0


def test_priority_counts_and_headers(spark):
    genes = spark.createDataFrame([("p",), ("q",), ("r",)], "protein string")
    members = {"metabolic": genes.filter("protein = 'p'"), "physiological": genes.filter("protein in ('p', 'q')")}
    got = {r.protein: r.classification for r in curate.classified(genes, members).collect()}
    assert got == {"p": "metabolic", "q": "physiological", "r": "unclassified"}
    rows = wide(spark, phrog_hmm_id="x", pfam_hmm_id="PF1", pfam_description="d").withColumn("top_hit_db", F.lit("PHROG")).withColumn("top_hit_hmm_id", F.lit("x")).withColumn("top_hit_description", F.lit("y"))
    assert rows.select(report.header_description()).first()[0] == '"PF1 d"'
    assert rows.withColumn("top_hit_db", F.lit("KEGG")).select(report.header_description()).first()[0] == '"x y"'
    level = spark.createDataFrame([("metabolic", None, "p"), ("metabolic", "low", "p")], "classification string, viral_origin_confidence string, protein string")
    assert [tuple(r) for r in report.category_counts(level).collect()] == [("metabolic", "low", 1)]


def test_scorers(spark):
    import pandas as pd

    class Half:
        features, thresholds = ["x", "near_flank", "none"], {"high": 0.9, "medium": 0.5}

        def probability(self, rows: pd.DataFrame) -> pd.Series:
            return rows["x"] / 10 + rows["none"] + 0 * rows["near_flank"]

    df = spark.createDataFrame([("c", 1.0, True), ("c", 9.0, None), ("c", None, False)], "contig string, x double, near_flank boolean")
    got = [(round(r.viral_prob, 3), r.viral_origin_confidence) for r in score.scored(df, Half(), ("contig",)).orderBy("viral_prob").collect()]
    assert got == [(0.1, "low"), (0.5, "medium"), (0.9, "high")]
