"""Circular contigs by terminal repeats, for contigs of any length."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..config import CircularitySettings

_COMPLEMENT = str.maketrans("ACTG", "TGAC")


def direct_repeat(seq: str, least: int) -> str:
    """The first suffix from the middle on that the sequence starts with too."""
    at = seq.find(seq[:least], -(-len(seq) // 2)) if seq else -1
    while at >= 0:
        if seq.startswith(seq[at:]):
            return seq[at:]
        at = seq.find(seq[:least], at + 1)
    return ""


def inverted_repeat(seq: str, least: int, most: int) -> str:
    """The common prefix with the reverse complement, from ``least`` on, cut at ``most``."""
    head, other = seq[:most], seq[-most:][::-1].translate(_COMPLEMENT)
    if head[:least] != other[:least]:
        return ""
    n = next((i for i, (a, b) in enumerate(zip(head, other, strict=False)) if a != b), len(head))
    return head[: max(n, least)]


_STEPS = np.random.default_rng(15).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def kmer_multiplicity(seq: str, k: int) -> float | None:
    """All k-mers by distinct ones, in 8 bytes for each; exact for up to 16 letters and 16 places, else by 64-bit hashes."""
    n = len(seq) - k + 1
    if n <= 0:
        return None
    codes = np.frombuffer(seq.encode("utf-32-le", "replace"), "<u4")
    letters, codes = np.unique(codes, return_inverse=True)
    packed = np.zeros(n, np.uint64)
    for i in range(k):
        part = codes[i : i + n].astype(np.uint64)
        packed = packed << np.uint64(4) | part if len(letters) <= 16 and k <= 16 else packed * np.uint64(0x9E3779B97F4A7C15) + (part + np.uint64(1)) * _STEPS[i % 256]
    return n / len(np.unique(packed))


def described(contig: str, seq: str, settings: CircularitySettings) -> dict:
    """A contig's circularity row; prediction_type is null without a repeat."""
    seq = (seq or "").upper()
    direct, inverted = direct_repeat(seq, settings.min_repeat), inverted_repeat(seq, settings.min_repeat, settings.max_inverted)
    kind = None if max(len(direct), len(inverted)) < settings.min_repeat else "DTR" if len(direct) >= len(inverted) else "ITR"
    repeat = {"DTR": direct, "ITR": inverted}.get(kind, "")
    out = dict.fromkeys(("repeat_length", "repeat_count", "repeat_n_freq", "repeat_mode_base_freq", "repeat_seq", "reason"))
    out |= {"contig": contig, "contig_length": len(seq), "kmer_freq": kmer_multiplicity(seq, settings.k), "prediction_type": kind}
    if repeat:
        mode = Counter(repeat).most_common(1)[0][1] / len(repeat)
        out |= {"repeat_length": len(repeat), "repeat_count": seq.count(repeat), "repeat_n_freq": repeat.count("N") / len(repeat), "repeat_mode_base_freq": mode, "repeat_seq": repeat}
        out["reason"] = (
            "Too many ambiguous bases in TR" if out["repeat_n_freq"] > settings.max_ambiguous
            else "Repetitive TR sequence" if out["repeat_count"] > settings.max_count
            else "Low complexity TR" if mode > settings.max_base_share else None
        )
    if (out["kmer_freq"] or 0) > settings.max_kmer_multiplicity:
        out["reason"] = "Multiple genome copies detected"
    return out | {"flagged": out["reason"] is not None}


def terminal_repeats(records: DataFrame, settings: CircularitySettings = CircularitySettings()) -> DataFrame:
    """Every contig's circularity row, in one narrow pass over name and sequence."""
    kind = pa.schema([(f.name, t) for f, t in zip(records.sparkSession.createDataFrame([], schemas.CIRCULAR).schema.fields, (pa.string(), pa.int64(), pa.float64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.bool_(), pa.string()), strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [described(name, seq, settings) for name, seq in zip(batch.column("name").to_pylist(), batch.column("seq").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, kind)

    return records.select("name", "seq").mapInArrow(run, schemas.CIRCULAR)


def circular_contigs(repeats: DataFrame) -> DataFrame:
    """Ids of contigs with a terminal repeat of either kind; quality flags don't matter."""
    return repeats.filter("prediction_type is not null").select(F.col("contig").alias("id")).distinct()
