"""Genome-context features along contigs.

Genes are ordered by number in their contig and measured along cumulated gene
length: gaps between genes don't count and circular contigs don't wrap.  With
``s`` and ``e`` a gene's start and end in that measure, the genes to the left of a
gene within W are those with ``s_i - s_j <= W``, those to the right start less than
W behind its end.  As a gene starts where the one before ends, both are RANGE
frames over a plain number, so all features of a contig are built-in window
aggregates behind one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTIG = ("genome", "contig")


class GeneFrames:
    """Window frames over genes with positive integer lengths and distinct numbers in their contig.

    ``positioned`` is the gene table with the cumulated start and end, and for
    each measure the value of the next gene.  A length below 1 raises.
    """

    def __init__(self, genes: DataFrame, measures: list[str], contig: tuple[str, ...] = CONTIG, number: str = "gene_number", length: str = "gene_length_bases"):
        self.contig, self.measures, self.columns = contig, measures, genes.columns
        order = Window.partitionBy(*contig).orderBy(number)
        size = F.when(F.col(length) >= 1, F.col(length).cast("long")).otherwise(F.raise_error(F.lit("gene lengths must be 1 or more")))
        rows = genes.withColumn("_len", size)
        rows = rows.withColumn("_e", F.sum("_len").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        rows = rows.withColumn("_s", F.col("_e") - F.col("_len"))
        after = {f"_next_{c}": F.lead(c).over(order) for c in dict.fromkeys(["_len", *measures])}
        self.positioned = rows.withColumns(after)
        self._length = "_len"

    def left(self, within: int):
        """The gene itself and those wholly within ``within`` before its start."""
        return Window.partitionBy(*self.contig).orderBy("_s").rangeBetween(-within, 0)

    def right(self, within: int):
        """Genes that start within ``within`` (inclusive) after its end, as rows of the gene before each."""
        return Window.partitionBy(*self.contig).orderBy("_e").rangeBetween(0, within)

    def length_near(self, window: int) -> Column:
        """Length of all genes in the window: the same for every column, so computed once."""
        here, ahead = self.left(window), self.right(window - 1)
        return F.sum(self._length).over(here) + F.coalesce(F.sum(f"_next_{self._length}").over(ahead), F.lit(0))

    def mean(self, column: str, window: int, min_valid_pct: float, length: Column) -> Column:
        """Unweighted mean of non-null values in the window; null if their genes are less than the share of its ``length``."""
        here, ahead = self.left(window), self.right(window - 1)
        after, next_len = F.col(f"_next_{column}"), F.col(f"_next_{self._length}")
        total = F.coalesce(F.sum(column).over(here), F.lit(0.0)) + F.coalesce(F.sum(after).over(ahead), F.lit(0.0))
        count = F.count(column).over(here) + F.count(after).over(ahead)
        valid = F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col(self._length))).over(here), F.lit(0)) + F.coalesce(F.sum(F.when(after.isNotNull(), next_len)).over(ahead), F.lit(0))
        return F.when((count > 0) & (valid * 100.0 / length >= min_valid_pct), total / count)

    def flags(self, mark: Column, mark_of_next: Column, within: int) -> tuple[Column, Column]:
        """Whether a marked gene lies upstream, and downstream, within (inclusive) the distance; null marks don't count."""
        own = F.coalesce(mark.cast("int"), F.lit(0))
        up = F.sum(own).over(self.left(within)) - own > 0
        down = F.coalesce(F.sum(F.coalesce(mark_of_next.cast("int"), F.lit(0))).over(self.right(within)), F.lit(0)) > 0
        return up, down


def gene_lengths(genes: DataFrame) -> DataFrame:
    """Adds length in bases and in amino acids (a third, cut off)."""
    n = F.col("contig_pos_end") - F.col("contig_pos_start") + 1
    return genes.withColumn("gene_length_bases", n).withColumn("prot_length_aas", (n / 3).cast("int"))


def contig_means(genes: DataFrame, columns: list[str], contig: tuple[str, ...] = CONTIG) -> DataFrame:
    """Adds ``contig_avg_<column>``, the mean over the contig's non-null values."""
    whole = Window.partitionBy(*contig)
    return genes.withColumns({f"contig_avg_{c}": F.avg(c).over(whole) for c in columns})


def window_means(genes: DataFrame, columns: list[str], window: int, min_valid_pct: float, contig: tuple[str, ...] = CONTIG, number: str = "gene_number", length: str = "gene_length_bases") -> DataFrame:
    """Adds ``window_avg_<column>``."""
    frames = GeneFrames(genes, columns, contig, number, length)
    rows = frames.positioned.withColumn("_near", frames.length_near(window))
    means = {f"window_avg_{c}": frames.mean(c, window, min_valid_pct, F.col("_near")) for c in columns}
    return rows.withColumns(means).select(*frames.columns, *means)


def score_flanks(genes: DataFrame, columns: list[str], within: int, least: float, contig: tuple[str, ...] = CONTIG, number: str = "gene_number", length: str = "gene_length_bases") -> DataFrame:
    """Adds ``<column>_flank_up`` and ``_flank_down``: a gene with a score of ``least`` or more is near."""
    frames = GeneFrames(genes, columns, contig, number, length)
    out = {}
    for c in columns:
        out[f"{c}_flank_up"], out[f"{c}_flank_down"] = frames.flags(F.col(c) >= least, F.col(f"_next_{c}") >= least, within)
    return frames.positioned.withColumns(out).select(*frames.columns, *out)


def in_set(df: DataFrame, ids: DataFrame, column: str, name: str, id_col: str = "id", normalize=None) -> DataFrame:
    """Adds the flag ``name``: whether ``column`` is in the id table; false for null."""
    key = normalize or (lambda c: c)
    marks = ids.select(key(F.col(id_col)).alias(f"_{name}_id")).filter(F.col(f"_{name}_id").isNotNull()).distinct().withColumn(name, F.lit(True))
    out = df.drop(name) if name in df.columns else df
    return out.join(marks, key(out[column]) == marks[f"_{name}_id"], "left").drop(f"_{name}_id").withColumn(name, F.coalesce(name, F.lit(False)))


def set_flanks(genes: DataFrame, marks: dict[str, str], within: int, both: bool = False, contig: tuple[str, ...] = CONTIG, number: str = "gene_number", length: str = "gene_length_bases") -> DataFrame:
    """For each boolean column ``marks[name]``: ``<name>_flank_up`` and ``_down``, or ``<name>_flank`` if ``both`` are one."""
    frames = GeneFrames(genes, list(dict.fromkeys(marks.values())), contig, number, length)
    out = {}
    for name, c in marks.items():
        up, down = frames.flags(F.col(c), F.col(f"_next_{c}"), within)
        out |= {f"{name}_flank": up | down} if both else {f"{name}_flank_up": up, f"{name}_flank_down": down}
    return frames.positioned.withColumns(out).select(*frames.columns, *out)
