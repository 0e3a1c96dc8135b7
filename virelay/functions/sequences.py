"""Column functions on nucleotide sequences; all take upper-case strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """Reversed, A-T and C-G exchanged; other letters stay."""
    return F.reverse(F.translate(seq, "ACTG", "TGAC"))


def kmer_multiplicity(seq: Column, k: int = 15) -> Column:
    """All k-mers by distinct ones; null if the sequence is shorter than ``k``.

    For short sequences: every k-mer is an array element.  Contigs go through
    :func:`virelay.operators.circular.terminal_repeats`.
    """
    n = F.length(seq) - (k - 1)
    mers = F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(seq, i, F.lit(k)))
    return F.when(n >= 1, n / F.size(F.array_distinct(mers)))


def direct_repeat(seq: Column, least: int = 20) -> Column:
    """The first suffix from the middle on that the sequence also starts with, ``least`` long or more; else empty."""
    first = F.ceil(F.length(seq) / 2).cast("int") + 1
    last = F.length(seq) - (least - 1)
    starts = F.filter(F.sequence(first, last), lambda p: F.substr(seq, p, F.lit(least)) == F.substr(seq, F.lit(1), F.lit(least)))
    ends = F.filter(F.transform(starts, lambda p: F.substr(seq, p)), lambda t: F.startswith(seq, t))
    return F.when(last >= first, F.coalesce(F.try_element_at(ends, F.lit(1)), F.lit(""))).otherwise(F.when(seq.isNotNull(), F.lit("")))


def inverted_repeat(seq: Column, least: int = 20, most: int = 1000) -> Column:
    """The longest common prefix, ``least`` to ``most`` long, with the reverse complement; else empty."""
    other = reverse_complement(seq)
    top = F.least(F.lit(most), F.length(seq))
    differs = F.filter(F.sequence(F.lit(least + 1), top), lambda i: F.substr(seq, i, F.lit(1)) != F.substr(other, i, F.lit(1)))
    n = F.when(top > least, F.coalesce(F.array_min(differs) - 1, top)).otherwise(F.lit(least))
    same = F.substring(seq, 1, least) == F.substring(other, 1, least)
    return F.when(same, F.substr(seq, F.lit(1), n)).otherwise(F.when(seq.isNotNull(), F.lit("")))


def count_of(seq: Column, part: Column) -> Column:
    """Occurrences of ``part`` that don't overlap; null for an empty part."""
    return F.when(F.length(part) > 0, ((F.length(seq) - F.length(F.replace(seq, part, F.lit("")))) / F.length(part)).cast("long"))


def base_share(seq: Column, base: str) -> Column:
    return (F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))) / F.nullif(F.length(seq), F.lit(0))


def mode_base_share(seq: Column, bases: str = "ACGTN") -> Column:
    """Share of the most frequent of ``bases``."""
    return F.greatest(*[base_share(seq, b) for b in bases])


def quality_reason(n_share: Column, count: Column, mode_share: Column, multiplicity: Column, settings) -> Column:
    """Why a terminal repeat is doubtful; null if it isn't. The number of genome copies outweighs the repeat."""
    return (
        F.when(multiplicity > settings.max_kmer_multiplicity, "Multiple genome copies detected")
        .when(n_share > settings.max_ambiguous, "Too many ambiguous bases in TR")
        .when(count > settings.max_count, "Repetitive TR sequence")
        .when(mode_share > settings.max_base_share, "Low complexity TR")
    )
