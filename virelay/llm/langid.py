"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent character n-grams (n up to 4, words
padded by a mark on both sides), best first.  A document is as far from a
language as its n-grams are out of place in the language's profile, those
missing there counting the whole profile's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import column, slices

PROFILE = 400
MAX_N = 4
UNKNOWN = "und"
#: Documents of each language that are learned from, at most about; frequencies settle long before.
SAMPLE_PER_LANG = 3000
#: Languages that are learned, the most frequent first.
LANGS = 256
#: Stands for whatever is no letter, between words.
GAP = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _letter_table() -> np.ndarray:
    """For each code point the code point of its (first) lower-case letter, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            table[cp] = ord(c.lower()[0])
    return table


_tables: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """The text's letters in lower case, each run of other characters as one gap, with a gap at both ends."""
    if not _tables:
        _tables.append(_letter_table())
    codes = _tables[0][np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    codes = np.concatenate([[np.uint32(GAP)], codes, [np.uint32(GAP)]])
    keep = codes != GAP
    keep[1:] |= codes[:-1] != GAP
    return codes[keep]  # a gap stays where a letter precedes it


def grams(text: str) -> np.ndarray:
    """The n-grams of a text as sorted 64-bit hashes of their code points.

    Words have a gap on both sides; an n-gram holds no gap but at its ends, and
    one of a single symbol is a letter.
    """
    s = symbols(text)
    if not len(s):
        return np.empty(0, np.int64)
    s = np.concatenate([[np.uint32(GAP)], s]).astype(np.uint64) + np.uint64(1)
    letter = s != GAP + 1
    parts, code = [s[letter]], s
    inner = np.ones(len(s), bool)  # no gap strictly inside
    for n in range(2, MAX_N + 1):
        code = code[:-1] * _STEP + s[n - 1 :]
        if n > 2:
            inner = inner[:-1] & letter[n - 2 : -1] if n > 3 else letter[1:-1]
            parts.append(code[inner])
        else:
            parts.append(code)
    out = np.concatenate(parts).view(np.int64)
    out.sort()
    return out


def counted(sorted_codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], sorted_codes[1:] != sorted_codes[:-1]])) if len(sorted_codes) else np.empty(0, np.int64)
    return sorted_codes[first], np.diff(np.append(first, len(sorted_codes)))


def top(codes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` most frequent codes, best first, ties to the smaller code."""
    if len(codes) > k:
        least = np.partition(counts, len(counts) - k)[len(counts) - k]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))[:k]]


class Profiles:
    """Language profiles as one table of ranks by n-gram."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.langs, self.size = sorted(profiles), size
        self.codes = np.unique(np.concatenate([np.empty(0, np.int64), *[np.asarray(profiles[x], np.int64) for x in self.langs]]))
        self.ranks = np.full((len(self.langs), len(self.codes) + 1), -1, np.int32)
        for row, lang in zip(self.ranks, self.langs, strict=True):
            row[np.searchsorted(self.codes, np.asarray(profiles[lang], np.int64))] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and 1 - distance / largest distance; ties to the first by name."""
        doc = top(*counted(grams(text)), self.size) if text else np.empty(0, np.int64)
        if not len(doc) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, doc)
        at = np.where((at < len(self.codes)) & (self.codes[np.minimum(at, len(self.codes) - 1)] == doc), at, len(self.codes))
        ranks = self.ranks[:, at]
        off = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(doc), dtype=np.int32)))
        far = off.sum(axis=1)
        best = int(far.argmin())
        return self.langs[best], float(1.0 - far[best] / (self.size * len(doc)))


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", order_col: str = "doc_id",
          size: int = PROFILE, per_lang: int = SAMPLE_PER_LANG, most_langs: int = LANGS) -> Profiles:
    """Profiles of the languages of ``df``'s rows with text and language.

    The ``most_langs`` languages with the most rows are learned (ties: the first
    by name).  About ``per_lang`` documents of each language are learned from (all, if it
    has fewer), picked by a hash of ``order_col``; n-grams are pre-counted where
    the rows are, so only counts by language and n-gram are exchanged.
    """
    rows = df.select(column(text_col).alias("text"), column(lang_col).alias("lang"), F.xxhash64(column(order_col).cast("string")).alias("h")).filter("text is not null and lang is not null")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs).collect()
    if not sizes:
        return Profiles({}, size)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, int(min(1.0, per_lang / r["count"]) * (1 << 30)))])
    picked = rows.filter(F.pmod("h", F.lit(1 << 30)) < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in slices(batches, "text", 4 << 20):
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by.setdefault(lang, []).append(grams(text))
            for lang, found in by.items():
                codes, counts = counted(np.sort(np.concatenate(found)))
                if lang in total:
                    codes, back = np.unique(np.concatenate([total[lang][0], codes]), return_inverse=True)
                    counts = np.bincount(back, np.concatenate([total[lang][1], counts])).astype(np.int64)
                total[lang] = codes, counts
        for lang, (codes, counts) in total.items():
            if len(codes):
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(codes), "gram": pa.array(codes), "n": pa.array(counts, pa.int64())})

    sums = picked.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = sums.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("r") <= size)
    profiles: dict[str, list[int]] = {}
    for row in ranked.orderBy("lang", "r").collect():  # ``size`` rows for each language
        profiles.setdefault(row.lang, []).append(row.gram)
    return Profiles(profiles, size)


def predict(df: DataFrame, profiles: Profiles, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` (default: all) with lang_pred and score, one row for each.

    Texts that are null, empty or without a letter give ``und`` and 0.  A column
    of ``df`` named like a result column is replaced by it.  Whole texts are
    read; no shuffle.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c not in ("lang_pred", "score")]
    # Inside, columns have numbers, so that no name can clash.
    sent = df.select(*[column(c).alias(f"c{k}") for k, c in enumerate(keep)], column(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            found = [profiles.predict(t) for t in batch.column("text").to_pylist()]
            out = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], [*keep, "lang_pred", "score"])

    fields = [T.StructField(c, f.dataType, f.nullable) for c, f in zip(keep, sent.schema.fields, strict=False)]
    return sent.mapInArrow(run, T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
