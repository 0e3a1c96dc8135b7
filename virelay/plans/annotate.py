"""The whole annotation run as one function over tables.

Stages are plans over fixed schemas; what several outputs need (the index with
hits, and the genes with context) is persisted, the rest is left to Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import CLASSES, SCORED, EngineConfig
from ..functions.names import nucleotide_file_name, strip_version
from ..operators import circular, context, curate, hits, report, score, sequences
from ..sources.fasta import gene_index
from ..sources.sinks import write_category_files, write_fasta, write_tsv
from .resume import kept


@dataclass
class Inputs:
    """Tables of a run. ``proteins`` and ``raw_hits`` are needed; the others may be left out.

    ``classes`` and ``keywords`` are keyed by metabolic, physiological and
    regulatory; a class's keywords are its hard and soft lists.
    """

    proteins: DataFrame
    raw_hits: DataFrame
    contigs: DataFrame | None = None
    thresholds: DataFrame | None = None
    vscores: DataFrame | None = None
    descriptions: DataFrame | None = None
    mobile: DataFrame | None = None
    hallmark: DataFrame | None = None
    classes: dict[str, DataFrame] = field(default_factory=dict)
    keywords: dict[str, tuple[list[str], list[str]]] = field(default_factory=dict)


@dataclass
class Results:
    """The outputs of a run, all lazy."""

    circular: DataFrame
    index: DataFrame
    best_hits: DataFrame
    context: DataFrame
    annotations: DataFrame
    curated: dict[str, DataFrame]
    final: DataFrame
    sequences: DataFrame
    missing: DataFrame
    contigs: DataFrame
    proteins: DataFrame

    def close(self) -> None:
        """Gives back what the session holds of the run."""
        self.context.unpersist()


class Engine:
    """Annotates and curates the genes of viral genomes."""

    def __init__(self, spark: SparkSession, config: EngineConfig = EngineConfig(), scorer: score.Scorer | score.RuleScorer | None = None, workdir: str | None = None, again: bool = False):
        """Without a ``scorer`` the origin stays open.  In ``workdir`` the hits and the genes with their context are kept, and a run that broke off goes on from them, unless ``again``."""
        self.spark, self.config, self.scorer = spark, config, scorer or score.NoScorer()
        self.workdir, self.again = workdir, again

    def _stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return kept(self.spark, f"{self.workdir}/{name}", build, self.again) if self.workdir else build()

    def _or_empty(self, table: DataFrame | None, schema: str) -> DataFrame:
        return table if table is not None else self.spark.createDataFrame([], schema)

    def annotate(self, inputs: Inputs) -> Results:
        """All outputs of a run; nothing is computed before one of them is used."""
        c = self.config
        contigs = self._or_empty(inputs.contigs, schemas.SEQUENCES)
        repeats = circular.terminal_repeats(sequences.long_enough(contigs, c.min_length), c.circularity)
        proteins = sequences.enough_genes(inputs.proteins, c.min_genes)
        index = gene_index(proteins)

        best = self._stage("best_hits", lambda: hits.best_hits(hits.accepted(inputs.raw_hits, self._or_empty(inputs.thresholds, schemas.THRESHOLDS), c), c.compat))
        genes = hits.annotated_index(index, best, self._or_empty(inputs.vscores, schemas.VSCORES), c.compat)
        genes = self.with_context(genes, circular.circular_contigs(repeats), self._or_empty(inputs.mobile, schemas.ID_SET), self._or_empty(inputs.hallmark, schemas.ID_SET))
        genes = self._stage("context", lambda: genes) if self.workdir else genes.persist(StorageLevel.MEMORY_AND_DISK)

        table = self.annotations(genes, self._or_empty(inputs.descriptions, schemas.DESCRIPTIONS))
        curated = {}
        for name in CLASSES:
            if name in inputs.classes:
                hard, soft = inputs.keywords.get(name, ([], []))
                own = curate.class_members(table, inputs.classes[name])
                curated[name] = curate.without_keywords(own, hard, soft, inputs.classes[name], self._or_empty(inputs.thresholds, schemas.THRESHOLDS), c)
        final = curate.classified(table, curated) if curated else table.withColumn("classification", F.lit("unclassified"))
        none = self.spark.createDataFrame([], "category string, confidence string, name string, description string, seq string")
        return Results(
            circular=repeats.filter("prediction_type is not null"), index=index, best_hits=best, context=genes, annotations=table, curated=curated,
            final=report.final_table(final),
            sequences=report.category_sequences(curated, proteins) if curated else none,
            missing=report.missing_sequences(curated, proteins) if curated else none.select("category", "name"),
            contigs=sequences.long_enough(contigs, c.min_length), proteins=proteins,
        )

    def with_context(self, genes: DataFrame, circular_ids: DataFrame, mobile: DataFrame, hallmark: DataFrame) -> DataFrame:
        """Contig and window means, flanks by score or hallmark and by mobile genes, and the origin label."""
        c = self.config
        measures = [f"{db.lower()}_{s}" for db in SCORED for s in ("v_score", "vl_score")]
        genes = context.contig_means(context.gene_lengths(genes), measures)
        genes = context.in_set(genes, circular_ids, "contig", "circular_contig")
        genes = context.window_means(genes, measures, c.window, c.min_valid_pct)
        names = [db.lower() for db in SCORED]
        marks = {}
        for p, db in zip(names, SCORED, strict=True):
            normalize = strip_version if c.normalize_pfam and db == "Pfam" else None
            genes = context.in_set(genes, mobile, f"{p}_hmm_id", f"{p}_mobile", normalize=normalize)
            if c.use_hallmark:
                genes = context.in_set(genes, hallmark, f"{p}_hmm_id", f"{p}_hallmark", normalize=normalize)
        if c.use_hallmark:
            genes = context.set_flanks(genes, {f"{p}_verified": f"{p}_hallmark" for p in names}, c.flank).drop(*[f"{p}_hallmark" for p in names])
        else:
            genes = context.score_flanks(genes, [f"{p}_v_score" for p in names], c.flank, c.min_flank_vscore)
            for p in names:
                genes = genes.withColumnsRenamed({f"{p}_v_score_flank_{d}": f"{p}_verified_flank_{d}" for d in ("up", "down")})
        marks = {f"{p}_mge": f"{p}_mobile" for p in names}
        genes = context.set_flanks(genes, marks, c.flank, both=True).drop(*marks.values())
        return score.scored(genes, self.scorer)

    def annotations(self, genes: DataFrame, descriptions: DataFrame) -> DataFrame:
        """The annotation table, in snake case."""
        names = [db.lower() for db in SCORED]
        rows = curate.described(genes, descriptions)
        top = curate.top_hit(self.config.compat)
        rows = rows.select(
            "*", *top,
            curate.any_flag(*[f"{p}_verified_flank_up" for p in names]).alias("viral_flanking_up"),
            curate.any_flag(*[f"{p}_verified_flank_down" for p in names]).alias("viral_flanking_down"),
            curate.any_flag(*[f"{p}_mge_flank" for p in names]).alias("mge_flanking"),
        )
        return rows.select(*schemas.ANNOTATION_COLUMNS, "gene_number").dropDuplicates()

    def write(self, results: Results, folder: str) -> None:
        """Writes the tables and sequence files of a run below ``folder``.

        ``results`` has the tables and a file for each class and confidence;
        ``wdir`` the circular contigs, and the contigs and proteins that passed
        the filters, in a folder for each source file.
        """
        write_tsv(results.circular, f"{folder}/wdir/circular_contigs.tsv", {c: c for c in schemas.CIRCULAR_COLUMNS})
        for name, records in (("contigs", results.contigs), ("proteins", results.proteins)):
            own = nucleotide_file_name(F.col("source_file")) if name == "contigs" else F.element_at(F.split("source_file", "/"), -1)
            write_fasta(records.withColumn("file", own), f"{folder}/wdir/filtered_{name}", by=["file"])
        write_tsv(results.context.orderBy("genome", "contig", "gene_number"), f"{folder}/results/genes_genomic_context.tsv")
        write_tsv(results.annotations.orderBy("genome", "contig", "gene_number"), f"{folder}/results/gene_annotations.tsv", schemas.ANNOTATION_COLUMNS)
        for name, table in results.curated.items():
            write_tsv(table.orderBy("genome", "contig", "gene_number"), f"{folder}/results/{schemas.OUTPUT_NAMES[name][1]}_genes_curated.tsv", schemas.ANNOTATION_COLUMNS)
        write_tsv(results.final, f"{folder}/results/final_results.tsv", schemas.FINAL_COLUMNS)
        files = {(name, level): f"faa_{schemas.OUTPUT_NAMES[name][0]}/{schemas.OUTPUT_NAMES[name][2]}_{level}{'' if level == 'all' else '_confidence'}.faa" for name in results.curated for level in ("high", "medium", "low", "all")}
        write_category_files(results.sequences, f"{folder}/results", files)
