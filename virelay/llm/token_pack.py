"""Token ids in fixed-width bit-packed files.

A file holds the documents of one range of ids, in ascending id order::

    payload  blocks of ids, each id in the least bits that hold the vocabulary
    index    documents x i64 id, documents x u8 "id is null",
             (documents + 1) x u64 first id position in the file
    offsets  (blocks + 1) x u64, each block's first byte
    tail     magic "VTOK2\\0\\0\\0", u32 bits per id, u32 ids per block, u64 documents,
             u64 ids, u64 blocks

What tells where things are comes last, so that a writer needs to hold no payload.
Ids are packed least significant bit first and each block starts at a byte, so
any id range is read from the blocks that cover it and unpacked by numpy alone.
"""

from __future__ import annotations

import contextlib
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunk_cache import ChunkIds, Odd, packed
from .common import column, shared_dir, slices

MAGIC = b"VTOK2\0\0\0"
TAIL = struct.Struct("<8sIIQQQ")
BLOCK = 8192
#: Ids that are read at once, but for a document that has more.
READ = 1 << 20

#: A chunk may end before a lone space, and before and after a lone newline: no
#: pre-token of the byte-level pattern reaches over these places.
CUTS = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?%#$*&|]{1,8})?")


def bits_for(vocabulary: int) -> int:
    """The least number of bits that holds every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Packs ids of one block; the last byte is filled with zero bits."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    if bits == 32:
        return ids.astype("<u4").tobytes()
    cells = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(cells.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a packed block."""
    if bits == 16:
        return np.frombuffer(data, "<u2", count).astype(np.uint32)
    if bits == 32:
        return np.frombuffer(data, "<u4", count).astype(np.uint32)
    cells = np.unpackbits(np.frombuffer(data, np.uint8), count=bits * count, bitorder="little").reshape(count, bits)
    return (cells.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class TokenFileWriter:
    """Writes the documents of one partition to an open binary file, as they come.

    Packed blocks go out at once; documents' ids, starts and the blocks' offsets
    follow them, and the counts that find these at the very end.  Memory holds
    less than a block of ids, and some 17 bytes for each document.
    """

    def __init__(self, out, bits: int, block: int = BLOCK):
        self.bits, self.block, self._out = bits, block, out
        self.doc_ids, self.nulls = array("q"), bytearray()
        self.starts, self.offsets = array("Q", [0]), array("Q", [0])
        self._rest = np.empty(0, np.uint32)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.starts.append(self.starts[-1] + len(ids))
        rest = np.concatenate([self._rest, ids]) if len(self._rest) else ids
        whole = len(rest) // self.block * self.block
        for a in range(0, whole, self.block):
            self._put(rest[a : a + self.block])
        self._rest = rest[whole:].astype(np.uint32)

    def _put(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self._out.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def finish(self) -> None:
        if len(self._rest):
            self._put(self._rest)
            self._rest = np.empty(0, np.uint32)
        for values, kind in ((self.doc_ids, "<i8"), (self.nulls, np.uint8), (self.starts, "<u8"), (self.offsets, "<u8")):
            self._out.write((np.frombuffer(values, np.uint8) if kind is np.uint8 else np.asarray(values).astype(kind)).tobytes())
        self._out.write(TAIL.pack(MAGIC, self.bits, self.block, len(self.doc_ids), self.starts[-1], len(self.offsets) - 1))


class TokenFile:
    """Random access to a file of :class:`TokenFileWriter` (any seekable binary file)."""

    def __init__(self, file):
        self._file = file
        end = file.seek(0, 2)
        if end is None:
            end = file.tell()
        if end < TAIL.size:
            raise ValueError("not a packed token file")
        file.seek(end - TAIL.size)
        magic, self.bits, self.block, docs, self.n_ids, blocks = TAIL.unpack(file.read(TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a packed token file")
        file.seek(end - TAIL.size - (8 * docs + docs + 8 * (docs + 1) + 8 * (blocks + 1)))
        self.doc_ids = np.frombuffer(file.read(8 * docs), "<i8")
        self.nulls = np.frombuffer(file.read(docs), np.uint8).astype(bool)
        self.starts = np.frombuffer(file.read(8 * (docs + 1)), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(file.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self._base = 0

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids at positions ``first`` to ``last`` (excluded)."""
        if last <= first:
            return np.empty(0, np.uint32)
        a, b = first // self.block, (last - 1) // self.block + 1
        self._file.seek(self._base + int(self.offsets[a]))
        data = memoryview(self._file.read(int(self.offsets[b] - self.offsets[a])))
        parts = []
        for k in range(a, b):
            count = min(self.block, self.n_ids - k * self.block)
            parts.append(unpack(data[self.offsets[k] - self.offsets[a] : self.offsets[k + 1] - self.offsets[a]], self.bits, count))
        return np.concatenate(parts)[first - a * self.block : last - a * self.block]

    def document(self, k: int) -> np.ndarray:
        """The ids of the ``k``-th document of the file."""
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def open_output(uri: str):
    """Opens ``uri`` for writing on whatever store it names; parents are created."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path)


def open_input(uri: str):
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


class ByteBpe:
    """Encodes with the tokenizers library, chunk by chunk.

    Texts are cut only where the vocabulary's pre-tokenizer always cuts, and the
    library encodes each frequent chunk once per worker; the ids are those of
    ``Tokenizer.encode(text, add_special_tokens=False)``.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._model = self.tokenizer.model
        # Byte-level vocabularies write bytes that are no printable Latin-1 as U+0100 and up, in order.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self._letters = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in shown)}
        self._first, self._spaced, self._any = ChunkIds(self._line_start), ChunkIds(self._after_space), ChunkIds(self._whole, 100_000)
        self._tails = ChunkIds(self._whole, 50_000)
        self._newline = self._whole("\n")

    def _whole(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _line_start(self, chunk: str) -> bytes:
        return self._word("", chunk)

    def _after_space(self, chunk: str) -> bytes:
        return self._word(" ", chunk)

    def _word(self, space: str, chunk: str) -> bytes:
        """A Latin word, perhaps with punctuation behind it, is one or two pre-tokens,
        which go to the library's model at once; all else goes through its whole encoding."""
        if m := WORD.fullmatch(chunk):
            stem, tail = m.groups()
            stem = space + stem
            mapped = stem.replace(" ", "\u0120") if stem.isascii() else stem.encode().decode("latin-1").translate(self._letters)
            ids = array("I", [t.id for t in self._model.tokenize(mapped)]).tobytes()
            return ids + self._tails[tail] if tail else ids
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise Odd
        return self._whole(space + chunk)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for t in texts:
            try:
                ids = packed(t, self._first, self._spaced, self._newline) if t else b""
            except Odd:
                ids = b"".join(map(self._any.__getitem__, CUTS.split(t)))
            out.append(np.frombuffer(ids, "<u4"))
        return out


_encoders: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """One encoder per worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]


MANIFEST = "path string, first_doc long, first_hash long, n_docs long, n_ids long"


def write_token_files(df: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                      folder: str | None = None, files: int | None = None) -> tuple[str, list]:
    """Encodes every text, appends ``end_id`` and writes packed files in ascending id order.

    Documents are range-partitioned by id (sampled bounds, ``files`` partitions,
    the session's shuffle partitions unless given), so one file is one range and
    files in range order are in id order.  Returns the folder and the manifest:
    a row per file, sorted, whose number doesn't depend on the number of rows.
    A task writes under a name of its own attempt and only what the manifest
    names counts, so lost executors and second attempts leave nothing wrong.

    Null text is an empty document (the end id alone); null ids sort first and
    are kept; repeated ids stay separate documents, ordered by a hash of their text.  An
    empty table gives no file.  Other columns are not read.
    """
    spark = df.sparkSession
    folder = folder or shared_dir(spark, "tokens")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer)
        out, end = None, np.array([end_id], np.uint32)
        with contextlib.ExitStack() as stack:
            for batch in slices(batches, "text"):
                ids = bpe.encode([t or "" for t in batch.column("text").to_pylist()])
                for doc, x, h in zip(batch.column("id").to_pylist(), ids, batch.column("h").to_pylist(), strict=True):
                    if out is None:
                        path, first = f"{folder}/{uuid.uuid4().hex}.vtok", (doc, h)
                        out = TokenFileWriter(stack.enter_context(open_output(path)), bits_for(max(bpe.tokenizer.get_vocab_size(), end_id + 1)))
                    out.add(doc, np.concatenate([x, end]))
            if out is not None:
                out.finish()
        if out is not None:  # the file is closed, so it is whole
            yield pa.RecordBatch.from_pydict({"path": [path], "first_doc": pa.array(first[:1], pa.int64()), "first_hash": pa.array(first[1:], pa.int64()), "n_docs": [len(out.doc_ids)], "n_ids": [int(out.starts[-1])]})

    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    docs = df.select(column(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    order = [F.col("id").asc_nulls_first(), F.col("h").asc()]  # the hash parts the rows of an id that very many have
    dealt = docs.repartitionByRange(files, *order).sortWithinPartitions(*order, "text")
    rows = dealt.mapInArrow(write, MANIFEST).collect()
    rows.sort(key=lambda r: (r.first_doc is not None, r.first_doc or 0, r.first_hash))
    return folder, rows


def read_token_files(spark, manifest: list) -> DataFrame:
    """The documents of the files: id, start (ids of all documents before), ids (array)."""
    return _read(spark, manifest, "doc_id long, start long, ids array<int>", lambda ids: pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), "ids")


def token_digests(spark, manifest: list) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of little-endian u32 ids), as read from the files."""

    def columns(ids):
        return pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())

    return _read(spark, manifest, "doc_id long, start long, n_tokens long, ids_crc32 long", columns, "ids_crc32")


def _read(spark, manifest: list, schema: str, value, name: str) -> DataFrame:
    starts = np.concatenate([[0], np.cumsum([r.n_ids for r in manifest])]).tolist() if manifest else [0]
    files = [(r.path, int(s)) for r, s in zip(manifest, starts, strict=False)]
    table = spark.createDataFrame(files, "path string, base long")
    if files:
        table = table.repartition(len(files))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with open_input(path) as f:
                    file = TokenFile(f)
                    a = 0
                    while a < len(file):  # documents of so many ids at once, or one
                        b = max(a + 1, int(np.searchsorted(file.starts, file.starts[a] + READ, side="right")) - 1)
                        edges = file.starts[a : b + 1]
                        block = file.ids(int(edges[0]), int(edges[-1]))
                        ids = [block[x - edges[0] : y - edges[0]] for x, y in zip(edges, edges[1:], strict=False)]
                        out = {"doc_id": pa.array(file.doc_ids[a:b], mask=file.nulls[a:b]), "start": pa.array(edges[:-1] + base, pa.int64())}
                        if "n_tokens" in schema:
                            out["n_tokens"] = pa.array(np.diff(edges), pa.int64())
                        yield pa.RecordBatch.from_pydict(out | {name: value(ids)})
                        a = b

    return table.mapInArrow(read, schema)
