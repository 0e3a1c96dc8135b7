"""``python -m virelay annotate``: a run from files to files."""

from __future__ import annotations

import argparse
import importlib
import json
import logging
import sys

from .config import EngineConfig

LOG = logging.getLogger("virelay")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="virelay", description="Annotates and curates genes of viral genomes with Spark.")
    commands = top.add_subparsers(dest="command", required=True)
    a = commands.add_parser("annotate", formatter_class=argparse.ArgumentDefaultsHelpFormatter)
    d = EngineConfig()
    a.add_argument("-i", "--input_type", choices=("nucl", "prot"), default="prot")
    a.add_argument("-g", "--genomes", help="nucleotide FASTA of single-contig genomes (for circularity)")
    a.add_argument("-vg", "--vmags", help="folder of nucleotide FASTA files, one for each genome")
    a.add_argument("-p", "--proteins", help="protein FASTA of single-contig genomes")
    a.add_argument("-vp", "--vmag_proteins", help="folder of protein FASTA files, one for each genome")
    a.add_argument("-d", "--hits", help="raw hit tables; a file's name tells its database")
    a.add_argument("-o", "--output", required=True)
    for name in ("vscores", "descriptions", "mobile", "hallmark", "kegg_cutoffs", "foam_cutoffs", "metabolic", "physiological", "regulatory", "false_metabolic", "false_physiological", "false_regulatory"):
        a.add_argument(f"--{name}", help="table of this name")
    a.add_argument("-l", "--min_len", type=int, default=d.min_length)
    a.add_argument("-f", "--min_orf", type=int, default=d.min_genes)
    a.add_argument("-n", "--min_annot", type=float, default=d.min_valid_pct, help="percent of a window's length that must have scores")
    a.add_argument("-c", "--cov_fraction", type=float, default=d.min_coverage)
    a.add_argument("-e", "--evalue", type=float, default=d.max_evalue)
    a.add_argument("-b", "--bitscore", type=float, default=d.min_bitscore)
    a.add_argument("-bh", "--bitscore_fraction_heuristic", type=float, default=d.bitscore_fraction)
    a.add_argument("-s", "--scaling_factor", type=float, default=d.soft_factor)
    a.add_argument("-Z", "--window_size", type=int, default=d.window)
    a.add_argument("-F", "--max_flank", type=int, default=d.flank)
    a.add_argument("-V", "--min_flank_Vscore", type=float, default=d.min_flank_vscore)
    a.add_argument("-H", "--use_hallmark", action="store_true")
    a.add_argument("--normalize_pfam", action="store_true")
    a.add_argument("--cutoffs", help="cut-offs of any database: db, hmm_id, value (gathering scores of Pfam and METABOLIC, for example)")
    a.add_argument("--scorer", choices=("none", "rule", "model"), default="none", help="what labels the viral origin; none leaves it open")
    for name in ("model", "model_features", "model_thresholds"):
        a.add_argument(f"--{name}", help="pickled artefact of --scorer model")
    a.add_argument("--gene_finder", help="module:function that finds genes in nucleotide input")
    a.add_argument("--profile_search", help="module:function that searches proteins, instead of --hits")
    a.add_argument("--again", action="store_true", help="do all stages again that an earlier run into the same output has kept")
    a.add_argument("--compat", action="store_true", help="keep the original tool's quirks")
    return top


def checked(args: argparse.Namespace, error) -> None:
    """Which inputs go with which input type."""
    if not (args.proteins or args.vmag_proteins or args.gene_finder):
        error("proteins are needed: --proteins, --vmag_proteins, or a --gene_finder for nucleotide input")
    if not (args.hits or args.profile_search):
        error("--hits or a --profile_search is needed")
    if args.scorer == "model" and not (args.model and args.model_features and args.model_thresholds):
        error("--scorer model needs --model, --model_features and --model_thresholds")
    if args.input_type == "prot" and (args.genomes or args.vmags):
        error("--genomes and --vmags go with --input_type nucl")
    if args.input_type == "nucl" and not (args.genomes or args.vmags):
        error("--input_type nucl needs --genomes, --vmags, or both")


def settings(args: argparse.Namespace) -> EngineConfig:
    return EngineConfig(
        args.min_len, args.min_orf, args.min_annot, args.cov_fraction, args.evalue, args.bitscore, args.bitscore_fraction_heuristic, args.scaling_factor,
        args.window_size, args.max_flank, args.min_flank_Vscore, args.use_hallmark, args.normalize_pfam, args.compat,
    )


class Lines(logging.Handler):
    """Keeps the run's log lines, which go to the output at its end."""

    def __init__(self):
        super().__init__()
        self.lines: list[str] = []
        self.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))

    def emit(self, record: logging.LogRecord) -> None:
        self.lines.append(self.format(record))


def named(function: str):
    """What ``module:function`` names."""
    module, _, name = function.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None) -> int:
    top = parser()
    args = top.parse_args(argv)
    checked(args, top.error)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    LOG.setLevel(logging.INFO)
    kept_lines = Lines()
    LOG.addHandler(kept_lines)
    LOG.info("command: %s", " ".join(sys.argv if argv is None else argv))

    from pyspark.sql import SparkSession

    from . import schemas
    from .operators import plugins, score
    from .operators.sequences import enough_genes, long_enough
    from .plans.annotate import Engine, Inputs
    from .sources import fasta, tables
    from .sources.files import concatenated

    spark = SparkSession.builder.appName("virelay").getOrCreate()
    optional = lambda path, read: read(path) if path else None
    cutoffs = tables.read_thresholds(spark, args.kegg_cutoffs, "KEGG", "threshold").unionByName(tables.read_thresholds(spark, args.foam_cutoffs, "FOAM", "cutoff_full"))
    cutoffs = cutoffs.unionByName(tables.read_cutoffs(spark, args.cutoffs))
    contigs = fasta.read_sequences(spark, args.genomes, args.vmags) if args.genomes or args.vmags else None
    if args.proteins or args.vmag_proteins:
        proteins = fasta.read_sequences(spark, args.proteins, args.vmag_proteins, fasta.PROTEIN)
    else:
        proteins = plugins.predicted_proteins(long_enough(contigs, args.min_len), named(args.gene_finder))
    names = ("metabolic", "physiological", "regulatory")
    inputs = Inputs(
        proteins=proteins,
        raw_hits=tables.read_raw_hits(spark, args.hits) if args.hits else plugins.searched(enough_genes(proteins, args.min_orf), named(args.profile_search)),
        contigs=contigs,
        thresholds=cutoffs,
        vscores=optional(args.vscores, lambda p: tables.read_csv(spark, p, schemas.VSCORES)),
        descriptions=optional(args.descriptions, lambda p: tables.read_csv(spark, p, schemas.DESCRIPTIONS)),
        mobile=optional(args.mobile, lambda p: tables.read_ids(spark, p)),
        hallmark=optional(args.hallmark, lambda p: tables.read_ids(spark, p)),
        classes={n: tables.read_class_list(spark, getattr(args, n)) for n in names if getattr(args, n)},
        keywords={n: tables.read_keywords(spark, getattr(args, f"false_{n}")) for n in names if getattr(args, f"false_{n}")},
    )
    scorer = {"none": lambda: None, "rule": score.RuleScorer, "model": lambda: score.load_scorer(args.model, args.model_features, args.model_thresholds)}[args.scorer]()
    engine = Engine(spark, settings(args), scorer, f"{args.output}/wdir/kept", args.again)
    run = engine.annotate(inputs)
    engine.write(run, args.output)
    for name, table in (("genes", run.index), ("best hits", run.best_hits), ("genes with context", run.context), ("annotations", run.annotations), *run.curated.items()):
        LOG.info("%s: %d rows", name, table.count())
    for row in run.final.groupBy("classification", "viral_origin_confidence").count().orderBy("classification", "viral_origin_confidence").collect():
        LOG.info("%s, %s: %d proteins", *row)
    for row in run.missing.groupBy("category").count().collect():
        LOG.warning("%d proteins of class %s have no sequence", row["count"], row.category)
    run.close()
    LOG.removeHandler(kept_lines)
    settings_file = "".join(f"{k}: {json.dumps(v)}\n" for k, v in sorted(vars(args).items()))
    for name, text in (("config_annotate.yaml", settings_file), ("annotate.log", "\n".join(kept_lines.lines))):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{args.output}/.parts")
        concatenated(spark, f"{args.output}/.parts", f"{args.output}/{name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
