"""Benchmark decontamination by SimHash of item-sized windows.

For each benchmark item, windows of as many words slide over every document.
Windows and items have a 64-bit SimHash of their weighted word shingles.  Items
are indexed by the four 16-bit blocks of their fingerprint, each block with all
values within ``RADIUS // 4`` bits: two fingerprints at most ``RADIUS`` bits apart
agree that far in at least one block, so none is missed.  What is found is
verified by the exact weighted Jaccard similarity of the shingle multisets.
A document shorter than an item is one window, compared by its shingles alone.

A window that shares no shingle with an item has similarity 0 to it.  So documents
are read once, and only the stretches around shingles that a bit set of all items'
shingles (of bounded size) has go on; from there on all work is on those
stretches, which meet the blocks of items whose shingles they hold.  There, windows
that hold a shingle of some item of their length are fingerprinted and looked up.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, discard, slices, stored
from .shingles import mix, windows, word_hashes

#: Fingerprints this far apart are found for certain; similar windows lie within it.
RADIUS = 19
BLOCKS = 4
#: Items and words of a block of items on the average.
ITEMS, WORDS = 512, 1 << 18
#: Stretches of documents that one task compares with one block, on the average.
STRETCHES = 512
#: Window starts that are fingerprinted at once.
STARTS = 4096
#: Bits of the set of all items' shingles: at least, at most, and for each shingle.
LEAST_BITS, MOST_BITS, BITS_EACH = 20, 28, 128


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """64-bit fingerprints from weighted bit sums (rows of 64)."""
    return np.packbits(sums > 0, axis=-1, bitorder="little").view("<u8")[..., 0]


def bit_votes(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each shingle its weight, positive or negative by each bit of its hash."""
    bits = np.unpackbits(mix(shingles).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return (bits.astype(np.float64) * 2 - 1) * weights[:, None]


def _near_masks(most: int) -> np.ndarray:
    """All 16-bit masks of at most ``most`` bits."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in itertools.combinations(range(16), k)], np.uint16)


class BlockIndex:
    """Multi-index over 16-bit blocks: all fingerprints within ``radius``."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        masks = _near_masks(radius // BLOCKS)
        blocks = prints.astype("<u8").view("<u2").reshape(-1, BLOCKS)
        self._tables = []
        for b in range(BLOCKS):
            values = (blocks[:, b, None] ^ masks).ravel()
            owner = np.repeat(np.arange(len(prints)), len(masks))
            order = np.argsort(values, kind="stable")
            self._tables.append((values[order], owner[order].astype(np.int32)))

    def near(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``asked``, item) of all fingerprints at most ``radius`` bits apart, each once."""
        blocks = asked.astype("<u8").view("<u2").reshape(-1, BLOCKS)
        found = []
        for b, (values, owner) in enumerate(self._tables):
            a = np.searchsorted(values, blocks[:, b])
            n = np.searchsorted(values, blocks[:, b], side="right") - a
            who = np.repeat(np.arange(len(asked)), n)
            at = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
            found.append(who * len(self.prints) + owner[at])
        pairs = np.unique(np.concatenate(found))
        who, item = np.divmod(pairs, len(self.prints))
        close = np.bitwise_count(asked[who] ^ self.prints[item]) <= self.radius
        return who[close], item[close]


@dataclass
class Size:
    """The items of one number of words."""

    words: int
    items: np.ndarray
    index: BlockIndex


class Weights:
    """Weights of shingles: one of many items weighs less, one of a single item or of none most."""

    def __init__(self, shingles: np.ndarray, df: np.ndarray, items: int):
        order = np.argsort(shingles)
        self.known, self.most = shingles[order], float(np.log1p(max(1, items)))
        self.weights = np.log1p(max(1, items) / df[order])

    def of(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(shingles), self.most)
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        return np.where(self.known[at] == shingles, self.weights[at], self.most)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets: distinct shingles with their total weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    inside = float(np.minimum(a[1][i], b[1][j]).sum())
    return inside / (float(a[1].sum()) + float(b[1].sum()) - inside)


def bag(shingles: np.ndarray, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    s, c = np.unique(shingles, return_counts=True)
    return s, c * weights.of(s)


class Items:
    """Items of one block (number, word hashes, weights), ready for the search."""

    def __init__(self, items: list[tuple[int, np.ndarray, Weights]], width: int, radius: int):
        self.width = width
        self.ids = [i for i, _, _ in items]
        self.shingles = [windows(w, width) for _, w, _ in items]
        self.bags = [bag(s, k) for s, (_, _, k) in zip(self.shingles, items, strict=True)]
        self.prints = np.array([fingerprint(bit_votes(s, k.of(s)).sum(axis=0)) for s, (_, _, k) in zip(self.shingles, items, strict=True)], np.uint64)
        self.lengths = np.array([len(w) for _, w, _ in items], np.int64)
        self.totals = np.array([b[1].sum() for b in self.bags])
        self.sizes = []
        for n in np.unique(self.lengths).tolist():
            own = np.flatnonzero(self.lengths == n)
            self.sizes.append(Size(n, own, BlockIndex(self.prints[own], radius)))
        # All shingles with their items, for documents shorter than an item.
        every, owners, weights = (np.concatenate(x) for x in zip(*((b[0], np.full(len(b[0]), i), b[1]) for i, b in enumerate(self.bags)), strict=True))
        order = np.argsort(every, kind="stable")
        self._every, self._owners, self._weights = every[order], owners[order], weights[order]

    def search(self, words: np.ndarray, weights: Weights, threshold: float, whole: bool = True) -> dict[int, tuple[float, int, int, int]]:
        """For each item found: similarity (negative), first word, words, bits apart of its best window.

        ``words`` are hashes of a document's words, or of a stretch of them that no
        shorter item leaves (then not ``whole``).
        """
        best: dict[int, tuple[float, int, int, int]] = {}
        if len(words) < self.width:
            return best
        s = windows(words, self.width)
        first = np.searchsorted(self._every, s)
        n = np.searchsorted(self._every, s, side="right") - first
        if not n.any():
            return best
        # Places of shingles with the length of each item that has them: only windows that hold one can be similar to it.
        place = np.repeat(np.arange(len(s)), n)
        length = self.lengths[self._owners[np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]]
        met = set(length.tolist())
        for size in self.sizes:
            if size.words > len(words):
                break
            if size.words not in met:
                continue
            members = np.unique(place[length == size.words])
            span = size.words - self.width + 1  # shingles of a window
            for a, b in _touching(members, span, len(s)):
                for a in range(a, b, STARTS):
                    part = s[a : min(a + STARTS, b) + span - 1]
                    votes = np.concatenate([np.zeros((1, 64)), np.cumsum(bit_votes(part, weights.of(part)), axis=0)])
                    prints = fingerprint(votes[span:] - votes[:-span])
                    who, item = size.index.near(prints)
                    apart = np.bitwise_count(prints[who] ^ size.index.prints[item])
                    for w, i, d in zip(who.tolist(), size.items[item].tolist(), apart.tolist(), strict=True):
                        score = similarity(bag(part[w : w + span], weights), self.bags[i])
                        if score >= threshold and (i not in best or (-score, a + w) < best[i][:2]):
                            best[i] = -score, a + w, size.words, d
        if whole and len(words) < self.sizes[-1].words:
            own = bag(s, weights)
            for i in self._longer(own, len(words), threshold):
                if (score := similarity(own, self.bags[i])) >= threshold:
                    mine = fingerprint(bit_votes(s, weights.of(s)).sum(axis=0))
                    best[i] = -score, 0, len(words), int(np.bitwise_count(mine ^ self.prints[i]))
        return best

    def _longer(self, own: tuple[np.ndarray, np.ndarray], words: int, threshold: float) -> list[int]:
        """Items of more than ``words`` words that a whole document of these shingles may reach the threshold with."""
        s, weight = own
        a = np.searchsorted(self._every, s)
        n = np.searchsorted(self._every, s, side="right") - a
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
        inside = np.bincount(self._owners[at], np.minimum(np.repeat(weight, n), self._weights[at]), len(self.totals))
        reached = inside >= (threshold - 1e-9) * (weight.sum() + self.totals - inside)
        return np.flatnonzero(reached & (inside > 0) & (self.lengths > words)).tolist()


def _touching(members: np.ndarray, span: int, total: int) -> list[tuple[int, int]]:
    """Ranges of window starts whose window holds a member."""
    first, last = np.maximum(0, members - span + 1), np.minimum(members, total - span)
    good = first <= last
    first, last = first[good], last[good]
    if not len(first):
        return []
    opens = np.concatenate([[True], first[1:] > last[:-1] + 1])
    return list(zip(first[opens].tolist(), (last[np.append(np.flatnonzero(opens)[1:] - 1, len(last) - 1)] + 1).tolist(), strict=True))


class BitSet:
    """Shingles as three bits each of ``1 << log`` bits: tells for certain what is not in it."""

    def __init__(self, log: int, words: list[tuple[int, int]]):
        self.log, self.bits = log, np.zeros(1 << (log - 6), np.uint64)
        if words:
            at, value = np.array(words, np.int64).T
            self.bits[at] = np.ascontiguousarray(value).view(np.uint64)

    def holds(self, shingles: np.ndarray) -> np.ndarray:
        """Places of the shingles that may be in the set."""
        at = np.arange(len(shingles))
        for shift in PLACES:
            place = (shingles[at] >> np.uint64(shift)) & np.uint64((1 << self.log) - 1)
            at = at[(self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0]
        return at


#: Where a shingle's places in the bit set begin among its 56 bits.
PLACES = (8, 22, 36)
STRETCH = "k1 long, k2 long, first long, n_words long, words binary, hits array<long>"


def item_words(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and word hashes of the items with text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            words = [word_hashes(t.encode("utf-8", "replace"))[0] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([w.astype("<u8").tobytes() for w in words], pa.binary())], ["id", "words"])

    rows = benchmark.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("text"))
    return rows.filter("id is not null and text is not null").mapInArrow(run, "id long, words binary")


def unsearchable(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """id of the items that are too short to have a shingle (or have no text): no document is called leaked for them."""
    short = item_words(benchmark, id_col, text_col).filter(F.octet_length("words") < 8 * width).select("id")
    none = benchmark.filter(column(text_col).isNull()).select(column(id_col).cast("long").alias("id"))
    return short.unionByName(none)


def _shingles(words: bytes, width: int) -> np.ndarray:
    return np.unique(windows(np.frombuffer(words, "<u8"), width)).view(np.int64)


def found(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, width: int, threshold: float, radius: int) -> DataFrame:
    """k1, k2, item_id, item_no, first_word, n_words, bits_apart, similarity of the best windows that reach the threshold.

    ``docs`` has k1, k2 and text.  Documents are read once.
    """
    spark = docs.sparkSession
    schema = "k1 long, k2 long, item_no long, item_id long, first_word long, n_words long, bits_apart int, similarity double"
    items = stored(item_words(benchmark, item_col, item_text_col).filter(F.octet_length("words") >= 8 * width).withColumn("no", F.monotonically_increasing_id()), "items")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("words")).alias("bytes"), F.max(F.octet_length("words")).alias("longest")).first()
    if not size.n:
        return spark.createDataFrame([], schema)
    blocks, longest = max(1, -(-size.n // ITEMS), -(-size.bytes // (8 * WORDS))), size.longest // 8
    block = F.pmod(F.xxhash64("no"), F.lit(blocks)).cast("int")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_shingles(w, width) for w in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("no"), pa.array(sets, pa.list_(pa.int64()))], ["no", "hits"])

    # Every shingle of the items with the number of items that have it, and their blocks.
    listed = items.select("no", "words").mapInArrow(distinct, "no long, hits array<long>")
    owned = listed.select("no", block.alias("block"), F.explode("hits").alias("shingle"))
    vocabulary = stored(owned.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.collect_set("block").alias("blocks")), "item-shingles")
    log = min(MOST_BITS, max(LEAST_BITS, int(vocabulary.count() * BITS_EACH).bit_length()))
    place = [F.shiftrightunsigned("shingle", shift).bitwiseAND(F.lit((1 << log) - 1)) for shift in PLACES]
    bits = vocabulary.select(F.explode(F.array(*place)).alias("p")).groupBy((F.col("p") / 64).cast("long").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("value"))
    # At most 1 << (MOST_BITS - 6) rows, whatever the benchmark.
    sent = spark.sparkContext.broadcast(BitSet(log, [(r["at"], r["value"]) for r in bits.collect()]))

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            rows: list[tuple] = []
            for k1, k2, text in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text")), strict=True):
                if not text:
                    continue
                words = word_hashes(text.encode("utf-8", "replace"))[0]
                if len(words) < width:
                    continue
                s = windows(words, width)
                hits = sent.value.holds(s)
                if not len(hits):
                    continue
                # All windows of any item's length that hold a hit lie in its stretch.
                lows, highs = np.maximum(0, hits + width - longest), np.minimum(len(words), hits + longest)
                opens = np.concatenate([[True], lows[1:] > np.maximum.accumulate(highs)[:-1]])
                edges = np.append(np.flatnonzero(opens), len(hits))
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    low, high = int(lows[a]), int(highs[b - 1])
                    rows.append((k1, k2, low, len(words), words[low:high].astype("<u8").tobytes(), np.unique(s[hits[a:b]]).view(np.int64)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in STRETCH.split(", ")])

    stretches = stored(docs.mapInArrow(touched, STRETCH).withColumn("no", F.monotonically_increasing_id()), "stretches")

    def knowing(rows: DataFrame, own: bool) -> DataFrame:
        """``no`` with its shingles' numbers of items, and the blocks that it has to meet."""
        terms = rows.select("no", F.explode("hits").alias("shingle")).join(vocabulary, "shingle")
        return terms.groupBy("no").agg(F.collect_list("shingle").alias("shingles"), F.collect_list("df").alias("dfs"), *([] if own else [F.array_distinct(F.flatten(F.collect_set("blocks"))).alias("blocks")]))

    met = stretches.select("no", "k1", "k2", "first", "n_words", "words").join(knowing(stretches, False), "no").withColumn("block", F.explode("blocks")).drop("blocks")
    met = stored(met, "met")
    salts = max(1, -(-met.count() // (STRETCHES * blocks)))
    asked = met.withColumn("part", F.col("block") * salts + F.pmod(F.xxhash64("no"), F.lit(salts)).cast("int")).drop("block")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    held = items.join(knowing(listed, True), "no").select("no", F.col("id").alias("k1"), F.lit(None).cast("long").alias("k2"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("n_words"), "words", "shingles", "dfs", block.alias("block"), copies.alias("salt"))
    held = held.withColumn("part", F.col("block") * salts + F.col("salt")).drop("block", "salt")
    n_items = size.n

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, ready = None, [], None
        for batch in batches:
            rows = []
            for part, no, k1, k2, first, n_words, words, shingles, dfs in zip(*(batch.column(c) for c in ("part", "no", "k1", "k2", "first", "n_words", "words", "shingles", "dfs")), strict=True):
                if (part := part.as_py()) != number:
                    number, waiting, ready = part, [], None
                weights = Weights(shingles.values.to_numpy().view(np.uint64), dfs.values.to_numpy(), n_items)
                hashed = np.frombuffer(words.as_py(), "<u8")
                if (first := first.as_py()) is None:
                    waiting.append(((no.as_py(), k1.as_py()), hashed, weights))
                elif waiting or ready:
                    if ready is None:
                        ready, waiting = Items(waiting, width, radius), []
                    for i, (score, at, n, apart) in ready.search(hashed, weights, threshold, len(hashed) == n_words.as_py()).items():
                        rows.append((k1.as_py(), k2.as_py(), *ready.ids[i], first + at, n, apart, -score))
            if rows:
                kinds = (*[pa.int64()] * 6, pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in schema.split(", ")])

    both = asked.unionByName(held)
    dealt = both.repartitionById(blocks * salts, F.col("part")).sortWithinPartitions("part", F.col("first").isNotNull())
    out = dealt.mapInArrow(search, schema)
    # A document's stretches are apart; the best window of them all counts.
    rest = F.struct((-F.col("similarity")).alias("far"), "first_word", "n_words", "bits_apart", "similarity")
    best = stored(out.groupBy("k1", "k2", "item_no", "item_id").agg(F.min(rest).alias("x")).select("k1", "k2", "item_id", "x.first_word", "x.n_words", "x.bits_apart", "x.similarity"), "leaks")
    discard(items, vocabulary, stretches, met)
    return best


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
          width: int = 5, threshold: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """Benchmark items found in documents: id, item_id, first_word, n_words, bits_apart, similarity.

    One row for each document row and item whose best window of the item's
    number of words reaches ``threshold`` (ties: the first window); where the item
    is longer than the document, the whole document is the one window, and it is
    verified whatever its fingerprint.  A shingle is ``width`` words; words are
    compared with A-Z in lower case.  Items of fewer words have no shingle and
    are not searched for (:func:`unsearchable` lists them); documents or items
    that are null, empty or without words give nothing; items with the same id are
    searched one by one and each gives its row.  Weights are counted over all
    items, so no result depends on the blocks.  Clean documents give no row.
    Documents are read whole, once; empty tables give no row.
    """
    docs = df.select(column(id_col).cast("long").alias("k1"), F.monotonically_increasing_id().alias("k2"), column(text_col).cast("string").alias("text"))
    return found(docs, benchmark, item_col, item_text_col, width, threshold, radius).withColumnRenamed("k1", "id").drop("k2")


def text_hashes(text_col: str) -> list[Column]:
    """128 bits of a text: texts that agree in them are one text."""
    text = column(text_col).cast("string")
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("text"), text).alias("k2")]


def drop_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               width: int = 5, threshold: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """``df`` without the documents in which :func:`leaks` finds an item.

    Decided by the text alone (128 bits of it): rows with equal or null ids are
    judged each by their own text, equal texts alike, null and empty ones stay.
    All columns stay as they are, whatever their names.
    """
    docs = df.select(*text_hashes(text_col), column(text_col).cast("string").alias("text"))
    gone = found(docs, benchmark, item_col, item_text_col, width, threshold, radius).select("k1", "k2").distinct()
    rows = df.select(F.struct(*[column(c) for c in df.columns]).alias("row"), *text_hashes(text_col))
    return rows.join(gone, ["k1", "k2"], "left_anti").select("row.*")
