import pytest
from pyspark.sql import functions as F

from virelay.config import CircularitySettings
from virelay.functions import sequences as seqs
from virelay.operators import circular, plugins
from virelay.operators import sequences as filters
from virelay.sources import fasta, sinks, tables


def test_fasta(spark, tmp_path):
    (tmp_path / "g.1.fasta").write_bytes(b">c_1 first one\r\nACGT\r\nac*\r\n>c_2\n\n>x_3 d\nA\n")
    (tmp_path / "h.txt").write_text(">no\nA\n")
    got = {r.name: r for r in fasta.read_fasta(spark, str(tmp_path), True, fasta.NUCLEOTIDE).collect()}
    assert {k: (r.description, r.seq, r.genome) for k, r in got.items()} == {"c_1": ("first one", "ACGTac*", "g.1"), "c_2": ("", "", "g.1"), "x_3": ("d", "A", "g.1")}
    with pytest.raises(FileNotFoundError):
        fasta.protein_records(spark, str(tmp_path))
    with pytest.raises(ValueError):
        fasta.read_sequences(spark)


def test_gene_index(spark):
    df = spark.createDataFrame([("a_b_3", "# 10 # 40 # -1 # ID=1", False, "")], "name string, description string, is_vmag boolean, genome string")
    assert tuple(fasta.gene_index(df).first()) == ("a_b", "a_b", "a_b_3", 3, 10, 40, -1, False)
    with pytest.raises(Exception, match="bad protein header"):
        fasta.gene_index(df.withColumn("description", F.lit("nothing"))).collect()


def test_filters(spark):
    df = spark.createDataFrame([("f", "c_1", "AAA"), ("f", "c_2", "A"), ("g", "c_3", "AAAA")], "source_file string, name string, seq string")
    assert {r.name for r in filters.enough_genes(df, 2).collect()} == {"c_1", "c_2"}
    assert {r.name for r in filters.long_enough(df, 3).collect()} == {"c_1", "c_3"}


REPEAT = "ACGTTGCATGCCATAGGCATCGATCGATTA"
CASES = {
    "dtr": REPEAT + "N" * 50 + REPEAT, "short": REPEAT[:19] + "N" * 50 + REPEAT[:19], "half": REPEAT + REPEAT,
    "itr": REPEAT + "R" + "N" * 49 + REPEAT[::-1].translate(str.maketrans("ACTG", "TGAC")), "long": "A" * 1500 + "R" + "T" * 1500, "none": "ACGTN" * 30 + "R", "tiny": "ACG", "empty": "",
}


def test_terminal_repeats_agree(spark):
    df = spark.createDataFrame(list(CASES.items()), "name string, seq string")
    rows = {r.contig: r for r in circular.terminal_repeats(df, CircularitySettings()).collect()}
    found = {k: (r.prediction_type, r.repeat_length) for k, r in rows.items()}
    assert found == {"dtr": ("DTR", 30), "short": (None, None), "half": ("DTR", 30), "itr": ("ITR", 30), "long": ("ITR", 1000), "none": (None, None), "tiny": (None, None), "empty": (None, None)}
    assert rows["long"].reason == "Multiple genome copies detected" and rows["dtr"].repeat_count == 2
    columns = {r.name: (r.d, r.i) for r in df.select("name", seqs.direct_repeat(F.col("seq")).alias("d"), seqs.inverted_repeat(F.col("seq")).alias("i")).collect()}
    for name, seq in CASES.items():
        assert columns[name] == (circular.direct_repeat(seq, 20), circular.inverted_repeat(seq, 20, 1000)), name
    assert df.select(seqs.kmer_multiplicity(F.col("seq"), 15)).filter("name = 'tiny'").first()[0] is None


def test_tables(spark, tmp_path):
    (tmp_path / "k.csv").write_text('substring,type\n"two\nlines",hard\nplain,SOFT\n')
    assert tables.read_keywords(spark, str(tmp_path / "k.csv")) == (["two\nlines"], ["plain"])
    (tmp_path / "Pfam.tsv").write_text("s\tPF1\t1.0E-05\t50.0\t10\t1\t9\nbroken\tline\n")
    assert [(r.db, r.hmm_id, r.end) for r in tables.read_raw_hits(spark, str(tmp_path / "Pfam.tsv")).collect()] == [("Pfam", "PF1", 9)]
    assert tables.read_ids(spark, str(tmp_path / "missing.csv")).count() == 0
    (tmp_path / "bad.tsv").write_text("a\tb\n1\tx\nno\ty\tz\n")
    good, bad = tables.read_permissive_tsv(spark, str(tmp_path / "bad.tsv"), "a int, b string")
    assert good.count() == 1 and bad.count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None, True, "AC"), ("b", "x y", False, "G")], "name string, description string, flag boolean, seq string")
    sinks.write_tsv(df, f"{tmp_path}/t", {"name": "Name", "flag": "Flag", "description": "D"})
    assert (tmp_path / "t").read_text() == "Name\tFlag\tD\na\ttrue\t\nb\tfalse\tx y\n"
    sinks.write_fasta(df.orderBy("name").coalesce(1), f"{tmp_path}/f")
    assert "".join(p.read_text() for p in (tmp_path / "f").glob("*.txt")) == ">a\nAC\n>b x y\nG\n"


def test_plugins(spark):
    df = spark.createDataFrame([("f", False, "c", "c", "", "ATGAAATAA")], "source_file string, is_vmag boolean, genome string, name string, description string, seq string")
    proteins = plugins.predicted_proteins(df, lambda name, seq: [(f"{name}_1", 1, len(seq), 1, "MK")])
    assert fasta.gene_index(proteins).first().contig_pos_end == 9
    found = plugins.searched(proteins, lambda rows: [("KEGG", n, "K1", 1e-9, 60.0, len(s), 1, len(s)) for n, s in rows])
    assert found.first().sequence == "c_1"


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from types import SimpleNamespace

    from virelay.sources import files

    def session(master, setting):
        context = SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: None, setCheckpointDir=lambda x: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, other: setting), sparkContext=context)

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError, match="checkpoint.dir"):
            files.scratch(session(master, None), "x")
        assert files.scratch(session(master, "hdfs://n/c/"), "x").startswith("hdfs://n/c/virelay/app/x-")
    assert files.scratch(session("local[4]", None), "x").startswith("file:///")
    path = files.scratch(spark, "gone")
    spark.range(3).write.parquet(path)
    files.remove(spark, path)
    assert not files.exists(spark, path)
