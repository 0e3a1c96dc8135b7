"""SentencePiece merge-type encoding by a score-ordered agenda of adjacent pairs.

An agenda holds every adjacent pair of symbols whose union is a piece, best
score first and leftmost among equals; taking pairs from it until it is empty
gives the library's segmentation.  Texts are cut only where no piece reaches
over (before a run of word marks, between characters that no piece has side by
side), so the agenda runs once per distinct chunk and worker.  In every Arrow batch
all chunks that the agenda has just encoded are checked against the library itself.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunk_cache import ChunkIds, Odd, packed
from .common import column, slices

MARK = "▁"
RUNS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class AgendaEncoder:
    """Encodes with a merge-type SentencePiece model without normalisation.

    Every newly encoded chunk is compared with the library (unless ``check`` is
    False), behind a newline, which no piece reaches over; an id that differs raises.
    """

    def __init__(self, path: str, check: bool = True):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(sp.get_piece_size())
        if any(sp.is_unused(i) for i in size):
            raise ValueError("models with unused pieces are not supported")
        special = {i for i in size if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        self.ids = {sp.id_to_piece(i): i for i in size if i not in special}
        self.order = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(sp.id_to_piece(i)[3:-1], 16): i for i in size if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        if any(MARK in p.lstrip(MARK) for p in self.ids) or sp.encode(" a  b ", out_type=str) and "".join(sp.encode(" a  b ", out_type=str)) != f"{MARK}{MARK}a{MARK}{MARK}b{MARK}":
            raise ValueError("only models with leading word marks and without normalisation are supported")
        # Two characters that no piece has side by side are never merged, whatever stands around them.
        self._joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self._split_lines = not any("\n" in p for p in self.ids)
        self._check, self._ahead = check, "a\n" if self._split_lines else ""
        self._new: list[tuple[str, list[int]]] = []
        self._first, self._spaced, self._any = ChunkIds(self._line_start, 60_000), ChunkIds(self._after_space, 300_000), ChunkIds(self._chunk, 40_000)
        self._newline = array("I", self.segment("\n")).tobytes()
        self._skip = len(sp.encode(self._ahead))

    def segment(self, chunk: str) -> list[int]:
        """The ids of one chunk, whose spaces are word marks already."""
        if (whole := self.ids.get(chunk)) is not None and len(chunk) == 1:
            return [whole]
        order, n = self.order, len(chunk)
        symbols: list[str] = list(chunk)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            if (score := order.get(chunk[i : i + 2])) is not None:
                agenda.append((score, i, 2))
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            _, i, length = pop(agenda)
            a = symbols[i]
            j = right[i]
            if not a or j >= n or len(a) + len(symbols[j]) != length:
                continue  # one of the two has been merged meanwhile
            merged = symbols[i] = a + symbols[j]
            symbols[j] = ""
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if (score := order.get(merged + symbols[k])) is not None:
                    push(agenda, (score, i, length + len(symbols[k])))
            h = left[i]
            if h >= 0 and (score := order.get(symbols[h] + merged)) is not None:
                push(agenda, (score, h, length + len(symbols[h])))
        out: list[int] = []
        known = self.ids
        for s in symbols:
            if s:
                if (i := known.get(s)) is not None:
                    out.append(i)
                elif self.bytes:
                    out += [self.bytes[b] for b in s.encode()]
                else:
                    out.append(self.unknown)
        return out

    def _chunk(self, chunk: str) -> bytes:
        ids = self.segment(chunk)
        if self._check:
            self._new.append((chunk, ids))
        return array("I", ids).tobytes()

    def _line_start(self, chunk: str) -> bytes:
        if MARK in chunk or not self._split_lines:
            raise Odd
        parts = self._parts(chunk)
        return self._chunk(chunk) if len(parts) == 1 else b"".join(map(self._first.__getitem__, parts))

    def _after_space(self, chunk: str) -> bytes:
        if not chunk or MARK in chunk or not self._split_lines:
            raise Odd
        parts = self._parts(chunk)
        if len(parts) == 1:
            return self._chunk(MARK + chunk)
        return self._spaced[parts[0]] + b"".join(map(self._first.__getitem__, parts[1:]))

    def _parts(self, chunk: str) -> list[str]:
        """The chunk cut wherever no piece joins two characters; an empty chunk has no part."""
        joined, parts, a = self._joined, [], 0
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in joined:
                parts.append(chunk[a:i])
                a = i
        if chunk:
            parts.append(chunk[a:])
        return parts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for t in texts:
            try:  # the mark that opens a text is that of a space before it
                ids = packed(" " + t, self._first, self._spaced, self._newline) if t else b""
            except Odd:
                ids = b"".join(map(self._any.__getitem__, RUNS.findall(MARK + t.replace(" ", MARK))))
            out.append(np.frombuffer(ids, "<u4"))
        self._compare()
        return out

    def _compare(self) -> None:
        """The library's word on all chunks encoded since the last time.

        Without lines to split, a chunk's first mark is the one that the library puts before any text.
        """
        if not self._new:
            return
        new, self._new = self._new, []
        if not self._ahead:
            new = [(c[1:], ids) for c, ids in new if c[0] == MARK and len(c) > 1]
        said = self.library.encode([self._ahead + c.replace(MARK, " ") for c, _ in new], num_threads=1)
        for (c, ids), theirs in zip(new, said, strict=True):
            if ids != theirs[self._skip :]:
                raise AssertionError(f"the library encodes {c!r} as {theirs[self._skip :]}, the agenda as {ids}")

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.library.decode([x.tolist() for x in ids], num_threads=1)


_encoders: dict[tuple[str, bool], AgendaEncoder] = {}


def encoder(path: str, check: bool = True) -> AgendaEncoder:
    """One encoder per worker process and model file."""
    if (path, check) not in _encoders:
        _encoders[path, check] = AgendaEncoder(path, check)
    return _encoders[path, check]


def encode_decode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True, digests: bool = False) -> DataFrame:
    """Per row of ``df``: id, n_tokens, ids (array<int>) and decoded (string).

    With ``digests`` the last two are their SHA-256 instead (ids in decimal,
    joined by commas; text in UTF-8), made where the ids are, so that they need
    not travel.  Null text is empty: no ids, decoded to the empty string.  Every
    row gives one row, repeated ids and texts included; other columns are not
    read.  One narrow pass without a shuffle.
    """
    schema = "id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agenda = encoder(model, check)
        for batch in slices(batches, "text", 2 << 20):
            ids = agenda.encode([t or "" for t in batch.column("text").to_pylist()])
            lists = [x.tolist() for x in ids]
            decoded = agenda.library.decode(lists, num_threads=1)
            out = {"id": batch.column("id"), "n_tokens": pa.array([len(x) for x in ids], pa.int64())}
            if digests:
                out["ids_sha256"] = pa.array([hashlib.sha256(str(x)[1:-1].replace(" ", "").encode()).hexdigest() for x in lists], pa.string())
                out["decoded_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())
            else:
                out["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
                out["decoded"] = pa.array(decoded, pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return df.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("text")).mapInArrow(run, schema)
