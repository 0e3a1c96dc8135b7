"""Places for external gene finders and profile searches, run inside ``mapInArrow``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .. import schemas

#: From (contig, sequence) to (protein name, start, end, frame, protein sequence).
GeneFinder = Callable[[str, str], Iterable[tuple[str, int, int, int, str]]]
#: From [(protein, sequence)] to (db, sequence, hmm_id, evalue, score, length, start, end).
ProfileSearch = Callable[[list[tuple[str, str]]], Iterable[tuple]]


def predicted_proteins(records: DataFrame, finder: GeneFinder) -> DataFrame:
    """Protein records with headers in the gene index's format; a contig at a time, where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = [r | {"name": name, "description": f"# {a} # {b} # {frame} #", "seq": seq} for name, a, b, frame, seq in finder(r["name"], r["seq"])]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, batch.schema)

    return records.mapInArrow(run, records.schema)


def searched(proteins: DataFrame, search: ProfileSearch, batch_size: int = 1000) -> DataFrame:
    """Raw hits of a profile search over batches of proteins.

    The search must use a fixed database size for its E-values, so that they don't
    depend on how proteins are dealt out.
    """
    names = [x.split()[0] for x in schemas.HITS_RAW.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, batch_size):
                part = batch.slice(a, batch_size)
                rows = list(search(list(zip(part.column("name").to_pylist(), part.column("seq").to_pylist(), strict=True))))
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows])

    return proteins.select("name", "seq").mapInArrow(run, schemas.HITS_RAW)
