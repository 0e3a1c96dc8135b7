"""A whole run on a small made-up genome, and a streamed one."""

from pyspark.sql import functions as F

from virelay import schemas
from virelay.config import EngineConfig
from virelay.operators import context
from virelay.plans.annotate import Engine, Inputs
from virelay.streaming.arriving import arriving_genes, window_means_of


def small(spark):
    proteins = spark.createDataFrame([("f", False, f"c_{n}", f"c_{n}", f"# {n * 1000} # {n * 1000 + 899} # 1 #", "MK" * 150) for n in range(1, 7)] + [("f", False, "d_1", "d_1", "# 1 # 90 # 1 #", "M")], schemas.SEQUENCES)
    hits = spark.createDataFrame([("KEGG", "c_1", "K1", 1e-30, 300.0, 300, 1, 290), ("Pfam", "c_2", "PF1.5", 1e-30, 200.0, 300, 1, 290), ("PHROG", "c_3", "phrog_9", 1e-30, 100.0, 300, 1, 290), ("KEGG", "c_4", "K2", 1e-30, 90.0, 300, 1, 290)], schemas.HITS_RAW)
    return Inputs(
        proteins, hits,
        vscores=spark.createDataFrame([("K1", 10.0, 9.0, "KEGG", ""), ("PF1.1", 10.0, 9.0, "Pfam", ""), ("phrog_9", 10.0, 9.0, "PHROG", "")], schemas.VSCORES),
        descriptions=spark.createDataFrame([("K1", "KEGG", "good enzyme"), ("K2", "KEGG", "bad lysin"), ("PF1.1", "Pfam", "domain")], schemas.DESCRIPTIONS),
        mobile=spark.createDataFrame([("phrog_9",)], schemas.ID_SET),
        classes={"metabolic": spark.createDataFrame([("K1", 1.0, 1.0, "KEGG", ""), ("K2", 1.0, 1.0, "KEGG", "")], schemas.CLASS_LIST), "physiological": spark.createDataFrame([("K1", 1.0, 1.0, "KEGG", ""), ("PF1", 1.0, 1.0, "Pfam", "")], schemas.CLASS_LIST)},
        keywords={"metabolic": (["lysin"], [])},
    )


def test_run(spark, tmp_path):
    run = Engine(spark, EngineConfig(min_genes=4, flank=900)).annotate(small(spark))
    rows = {r.protein: r for r in run.annotations.collect()}
    assert set(rows) == {f"c_{n}" for n in range(1, 7)}
    assert run.annotations.columns == [*schemas.ANNOTATION_COLUMNS, "gene_number"] and len(schemas.ANNOTATION_COLUMNS) == 38
    assert (rows["c_1"].viral_flanking_up, rows["c_1"].viral_flanking_down, rows["c_2"].viral_flanking_up) == (False, True, True)
    assert rows["c_5"].top_hit_db is None and not rows["c_5"].viral_flanking_down and rows["c_2"].mge_flanking
    assert rows["c_2"].pfam_description == "domain" and not rows["c_2"].circular_contig
    assert {r.protein for r in run.curated["metabolic"].collect()} == {"c_1"}
    final = run.final.collect()
    assert [(r.protein, r.classification) for r in final[:2]] == [("c_1", "metabolic"), ("c_2", "physiological")] and len(final) == 6
    assert {(r.category, r.name) for r in run.sequences.filter("confidence = 'all'").collect()} == {("metabolic", "c_1"), ("physiological", "c_1"), ("physiological", "c_2")}
    Engine(spark).write(run, str(tmp_path))
    lines = (tmp_path / "results/final_results.tsv").read_text().splitlines()
    assert lines[0].split("\t") == list(schemas.FINAL_COLUMNS.values()) and [x.split("\t")[0] for x in lines[1:3]] == ["c_1", "c_2"] and len(lines) == 7
    assert (tmp_path / "results/physiology_genes_curated.tsv").read_text().startswith("Protein\t") and (tmp_path / "results/faa_physiology/APGs_high_confidence.faa").read_text() == ""
    assert (tmp_path / "results/faa_metabolic/AMGs_all.faa").read_text().startswith('>c_1 "K1 good enzyme"\nMK')
    assert (tmp_path / "wdir/filtered_proteins/file=f").exists() and {r.viral_origin_confidence for r in final} == {None}
    run.close()


def test_streamed_batches_equal_the_table(spark, tmp_path):
    genes = spark.createDataFrame([("g", c, n, 10, float(n)) for c in "abc" for n in range(1, 6)], "genome string, contig string, gene_number long, gene_length_bases long, v double")
    for c in "abc":
        genes.filter(F.col("contig") == c).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = arriving_genes(spark, f"{tmp_path}/in", genes.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "), 1)
    window_means_of(stream, f"{tmp_path}/out", f"{tmp_path}/check", ["v"], 20, 0.0).awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    want = context.window_means(genes, ["v"], 20, 0.0)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_command(spark, tmp_path):
    from virelay.__main__ import main

    (tmp_path / "p.faa").write_text("".join(f">c_{n} # {n * 1000} # {n * 1000 + 899} # 1 # x\n{'MK' * 150}\n" for n in range(1, 7)))
    (tmp_path / "KEGG.tsv").write_text("c_1\tK1\t1.0E-30\t300.0\t300\t1\t290\n")
    (tmp_path / "m.tsv").write_text("id\tV-score\tVL-score\tdb\tname\nK1\t1\t1\tKEGG\tx\n")
    assert main(["annotate", "-p", f"{tmp_path}/p.faa", "-d", f"{tmp_path}/KEGG.tsv", "-o", f"{tmp_path}/out", "--metabolic", f"{tmp_path}/m.tsv"]) == 0
    results = tmp_path / "out/results"
    assert (results / "metabolic_genes_curated.tsv").read_text().count("\n") == 2 and (results / "faa_metabolic/AMGs_all.faa").read_text().startswith(">c_1")
    assert "hits:" in (tmp_path / "out/config_annotate.yaml").read_text()
    assert "genes: 6 rows" in (tmp_path / "out/annotate.log").read_text() and "command: " in (tmp_path / "out/annotate.log").read_text()


def test_command_with_cutoffs_scorer_plugins_and_kept_stages(spark, tmp_path):
    from virelay.__main__ import main

    (tmp_path / "g.fna").write_text("".join(f">{c}\n{'ACGT' * 1500}\n" for c in "ab") + ">short\nACGT\n")
    (tmp_path / "cut.csv").write_text("db,hmm_id,value\nKEGG,K0,1000000\n")
    common = ["annotate", "-i", "nucl", "-g", f"{tmp_path}/g.fna", "--gene_finder", "virelay.plans.detail_queries:two_genes", "--profile_search", "virelay.plans.detail_queries:by_length", "-f", "2"]
    assert main([*common, "-o", f"{tmp_path}/out", "--scorer", "rule"]) == 0
    rows = [x.split("\t") for x in (tmp_path / "out/results/final_results.tsv").read_text().splitlines()]
    assert sorted(r[0] for r in rows[1:]) == ["a_1", "a_2", "b_1", "b_2"] and {r[4] for r in rows[1:]} == {"low"} and all("K0" in r for r in rows[1:])
    # Kept stages answer for the same output; a cut-off counts once they are done again.
    assert main([*common, "-o", f"{tmp_path}/out", "--cutoffs", f"{tmp_path}/cut.csv"]) == 0
    assert "K0" in (tmp_path / "out/results/final_results.tsv").read_text()
    assert main([*common, "-o", f"{tmp_path}/out", "--cutoffs", f"{tmp_path}/cut.csv", "--again"]) == 0
    assert "K0" not in (tmp_path / "out/results/final_results.tsv").read_text()


def test_circularity_of_whole_texts_equals_brute_force(spark, data):
    from virelay.plans import detail_queries

    texts = {str(r.doc_id): (r.text or "").upper() for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = {r.contig: r for r in detail_queries.circularity_of_texts(spark, data).collect()}
    assert set(rows) == set(texts)
    for name, seq in texts.items():
        n = len(seq) - 14
        direct = next((seq[p:] for p in range(-(-len(seq) // 2), len(seq) - 19) if seq.startswith(seq[p : p + 20]) and seq.startswith(seq[p:])), "")
        assert rows[name].contig_length == len(seq) and (rows[name].prediction_type == "DTR") == bool(direct)
        assert rows[name].kmer_freq == (round(n / len({seq[i : i + 15] for i in range(n)}), 6) if n > 0 else None)


def test_category_and_hit_table_warnings(spark, tmp_path, caplog):
    from virelay.sources import tables

    (tmp_path / "good.tsv").write_text("db\tsequence\thmm_id\tevalue\tscore\tlength\tstart\tend\nPfam\ts\tPF1\t1e-5\t9.5\t10\t1\t9\nbroken\n")
    got = tables.read_hit_tables(spark, [f"{tmp_path}/good.tsv", f"{tmp_path}/missing.tsv"]).collect()
    assert [(r.sequence, r.score) for r in got] == [("s", 9.5)]
    assert "missing.tsv can't be read" in caplog.text and "1 lines of" in caplog.text
    assert tables.read_ids(spark, f"{tmp_path}/none.csv").count() == 0 and "no id table" in caplog.text


def test_command_refuses_wrong_inputs(capsys):
    import pytest

    from virelay.__main__ import main

    for bad in (["annotate", "-d", "x", "-o", "y"], ["annotate", "-p", "x", "-o", "y"], ["annotate", "-p", "a", "-d", "x", "-o", "y", "--scorer", "model"], ["annotate", "-d", "x", "-o", "y", "-p", "a", "-g", "b"], ["annotate", "-d", "x", "-o", "y", "-p", "a", "-i", "nucl"]):
        with pytest.raises(SystemExit):
            main(bad)


def test_stages_are_kept(spark, tmp_path):
    from virelay.plans.resume import kept

    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert [kept(spark, f"{tmp_path}/s", build).count() for _ in range(2)] == [3, 3] and len(calls) == 1
    (tmp_path / "s/_SUCCESS").unlink()
    assert kept(spark, f"{tmp_path}/s", build).count() == 3 and len(calls) == 2


def test_model_scorer(spark, tmp_path):
    import pickle

    import numpy as np

    from virelay.operators import score

    for name, value in (("m", Halves()), ("f", ["x"]), ("t", {"high": {"threshold": 0.9}, "medium": {"threshold": 0.5}})):
        (tmp_path / name).write_bytes(pickle.dumps(value))
    scorer = score.load_scorer(*[f"{tmp_path}/{n}" for n in "mft"])
    rows = spark.createDataFrame([("c", 0.5)], "contig string, x double").toPandas()[["x"]]
    assert scorer.probability(rows).tolist() == [0.5] and scorer.thresholds["high"] == 0.9 and np is not None


class Halves:
    def predict_proba(self, rows):
        import numpy as np

        return np.column_stack([1 - rows["x"], rows["x"]])
