"""Exact Jaccard join of word-shingle sets by partitioning the hash universe.

Sets are banded by size.  For a band whose pairs differ in at most ``t`` tokens
the hash universe is cut into segments; of ``t + 1 + slack`` segments at least
one non-empty one holds the same subset in both sets of a pair, so equal
(band, segment, subset) signatures find every pair.  A set with more empty
segments than the slack adds the one-deletion neighbourhoods of its subsets, and
bands whose pairs differ in one token at most index the whole set's one-deletion
neighbourhood instead.  A cost model picks the scheme and slack of each band.

Equal sets are one class from the start.  The runs of sets with one signature are
gathered under the set that shares most signatures, and the sets of each group
are compared exactly, all with all, as products of blocks of bounded size; what
goes on from there is a spanning forest of the links, never all pairs.
"""

from __future__ import annotations

import bisect
import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, discard, release_memory, slices, stored
from .components import components
from .shingles import mix, packed_set, set_hash, shingle_set, unpacked_set

#: Ratio of a band's largest to its smallest set.
RATIO = 1.25
#: Sets and tokens of a group that are compared at once.
BLOCK_SETS, BLOCK_TOKENS = 1024, 1 << 20


def least_overlap(a: int, b: int, num: int, den: int) -> int:
    """The smallest intersection of sets of ``a`` and ``b`` with Jaccard at least num/den."""
    return -(-num * (a + b) // (num + den))


@dataclass(frozen=True)
class Band:
    """Sets from ``low`` to ``high`` as the smaller of a pair."""

    number: int
    low: int
    high: int
    differ: int
    segments: int
    slack: int

    @property
    def whole(self) -> bool:
        """One segment with one-deletion neighbourhoods for all sets."""
        return self.segments == 1


def _differ(low: int, high: int, num: int, den: int) -> int:
    """The most tokens in which a linked pair whose smaller set is in the band differs.

    That is, over all sums of two sizes that such a pair can have.
    """
    sums = np.arange(2 * low, high + high * den // num + 1)
    return max(0, int((sums - 2 * -(-num * sums // (num + den))).max()))


def _allocated(number: int, low: int, high: int, num: int, den: int) -> Band:
    """The band's scheme: least signatures, those of sets beyond the slack counted in."""
    t = _differ(low, high, num, den)
    if t <= 1:
        return Band(number, low, high, t, 1, 0)
    best, cost, slack = None, math.inf, 0
    while slack <= 8 + t // 2:
        m = t + 1 + slack
        empty = (1 - 1 / m) ** low
        beyond = _beyond(m, empty, slack)
        # Subsets of one token are little selective: they count three times.
        price = m * (1 + 2 * math.exp(-low / m) * low / m) + beyond * (low + m)
        if price < cost:
            best, cost = Band(number, low, high, t, m, slack), price
        slack += max(1, slack // 8)
    return best


def _beyond(n: int, p: float, k: int) -> float:
    """Chance of more than ``k`` of ``n`` independent events of chance ``p``."""
    if p <= 0:
        return 0.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    return max(0.0, 1 - sum(math.exp(x) for x in logs))


_bands: dict[tuple[int, int], list[Band]] = {}


def band_of(size: int, num: int, den: int) -> Band:
    """The band that holds ``size``; bands depend on the threshold alone."""
    bands = _bands.setdefault((num, den), [])
    while not bands or bands[-1].high < size:
        low = bands[-1].high + 1 if bands else 1
        high = max(low, int(low * RATIO))
        while low == 1 and _differ(1, high + 1, num, den) <= 1:
            high += 1
        bands.append(_allocated(len(bands), low, high, num, den))
    return bands[bisect.bisect_left(bands, size, key=lambda b: b.high)]


def signatures(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """The signatures of a set (ascending hashes) in all bands where it may have a partner."""
    n = len(tokens)
    if not n:
        return tokens
    mixed = mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
    out, size = [], -(-num * n // den)
    while size <= n:
        band = band_of(size, num, den)
        size = band.high + 1
        name = np.uint64((band.number << 32) & 0xFFFFFFFFFFFFFFFF)
        if band.whole:
            if band.differ:  # else only equal sets link
                out += [mix(sums[-1:] + name), *([mix(sums[-1] - mixed + name)] if n > 1 else [])]
            continue
        m = band.segments
        edge = np.append(np.searchsorted(tokens, _edges(m)), n)
        count = np.diff(edge)
        subset = sums[edge[1:]] - sums[edge[:-1]]
        full = count > 0
        ids = name + np.arange(m, dtype=np.uint64)
        out.append(mix(mix(subset[full]) + ids[full]))
        empty = m - int(full.sum())
        if empty > band.slack:  # pairs of such sets may differ in every segment that isn't empty in both
            owner = np.repeat(np.arange(m), count)
            several = count[owner] > 1
            own = subset[owner][several] - mixed[several]
            deep = np.uint64(1 << 31)
            out += [mix(mix(own) + ids[owner][several] + deep), mix(mix(subset[full]) + ids[full] + deep)]
        if empty > band.slack + 1:  # with ever so many empty segments: rarest tokens by hash order, which share one
            out.append(mix(tokens[: n - -(-num * n // den) + 1] + name + np.uint64(1 << 30)))
    return np.concatenate(out) if out else tokens[:0]


@functools.cache
def _edges(m: int) -> np.ndarray:
    return np.array([(k << 64) // m for k in range(m)], np.uint64)


ROWS = "sig long, key long, size int, id long, text_hash long, member boolean"


def _signature_rows(sig, key, size) -> pa.RecordBatch:
    none = pa.nulls(len(sig), pa.int64())
    columns = [pa.array(sig, pa.int64()), pa.array(key, pa.int64()), pa.array(size, pa.int32()), none, none, pa.array(np.zeros(len(sig), bool))]
    return pa.RecordBatch.from_arrays(columns, ["sig", "key", "size", "id", "text_hash", "member"])


def _indexed(width: int, num: int, den: int):
    """A member row for each document, and the signature rows of each set new to the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            keys, sizes, seen, parts = [], [], set(), []
            for text in batch.column("text").to_pylist():
                tokens = shingle_set(text or "", width)
                key = set_hash(tokens)
                keys.append(key)
                sizes.append(len(tokens))
                if key not in seen and len(tokens):
                    seen.add(key)
                    sig = signatures(tokens, num, den)
                    parts.append((sig, key, len(tokens)))
            own = pa.array(keys, pa.int64())
            yield pa.RecordBatch.from_arrays([own, own, pa.array(sizes, pa.int32()), batch.column("id"), batch.column("text_hash"), pa.array(np.ones(len(keys), bool))], ["sig", "key", "size", "id", "text_hash", "member"])
            if parts:
                each = [len(p[0]) for p in parts]
                sig = np.concatenate([p[0] for p in parts]).view(np.int64)
                yield _signature_rows(sig, np.repeat([p[1] for p in parts], each), np.repeat([p[2] for p in parts], each))

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in signature order: member rows, and the distinct sets of signatures that several sets have.

    Only the last set of an unfinished run is held from batch to batch.
    """
    held, told = None, False  # the last signature row so far, and whether it has been passed on
    for batch in batches:
        member = batch.column("member").to_numpy(zero_copy_only=False)
        if member.any():
            yield batch.filter(batch.column("member"))
        own = np.flatnonzero(~member)
        if not len(own):
            continue
        sig, key, size = (batch.column(c).to_numpy()[own] for c in ("sig", "key", "size"))
        if held is not None:
            sig, key, size = (np.concatenate([[x], y]) for x, y in zip(held, (sig, key, size), strict=True))
        fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])])
        sig, key, size = sig[fresh], key[fresh], size[fresh]
        same = sig[1:] == sig[:-1]
        several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        passed = bool(several[-1]) or (len(sig) == 1 and told)
        several[0] &= not told
        if several.any():
            yield _signature_rows(sig[several], key[several], size[several])
        held, told = (sig[-1], key[-1], size[-1]), passed


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            sets = [shingle_set(t or "", width) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "tokens": pa.array(map(packed_set, sets), pa.binary()), "bits": pa.array(map(bitmap, sets), pa.binary())})

    return run


def first_row():
    """What the row of least id is least in; null ids come last."""
    return F.struct(F.col("id").isNull(), "id", "text_hash")


def _classes(df: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """Per row: id, text_hash, n_shingles and root (a number for each component; null without shingles)."""
    text = column(text_col).cast("string")
    docs = df.select(column(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.mapInArrow(_indexed(width, num, den), ROWS)
    dealt = rows.repartition(parts, "sig").sortWithinPartitions("sig", "key").mapInArrow(_shared, ROWS)
    table = stored(dealt, "jaccard-index")
    members = table.filter("member").select("id", F.col("size").cast("long").alias("n_shingles"), "key", "text_hash")
    runs = table.filter("not member").select("sig", "key", "size")
    # Each run's sets meet under the one that shares most signatures (ties: the smaller key), so
    # runs of one group of near copies mostly meet under one; every pair of a run meets there.
    shared = runs.groupBy("key").agg(F.count(F.lit(1)).alias("shared"))
    lead = runs.join(shared, "key").groupBy("sig").agg(F.max_by("key", F.struct("shared", "key")).alias("lead"))
    groups = stored(runs.join(lead, "sig").groupBy("lead", "key").agg(F.first("size").alias("size")), "jaccard-groups")
    sets = _tokens(docs, members, groups.select("key").distinct(), width)
    # A group of up to BLOCK_SETS sets and BLOCK_TOKENS tokens is compared whole; larger ones in pairs of blocks.
    # First by bitmaps, which tell most sets apart for certain, then those left by their tokens.
    sizes = groups.groupBy("lead").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens")).filter("n > 1")
    # Written, so that the join with the sets of a large group can be split.
    sizes = stored(sizes.select("lead", F.ceil(F.greatest(F.col("n") / BLOCK_SETS, F.col("tokens") / BLOCK_TOKENS)).cast("int").alias("blocks")), "jaccard-blocks")
    dealt = groups.join(sizes, "lead").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(F.xxhash64("lead", F.least("block", "with"), F.greatest("block", "with")).alias("cell"), "key", "size")
    dealt = dealt.join(sets.select("key", "bits"), "key").repartition(parts, "cell").sortWithinPartitions("cell", "key")
    close = stored(dealt.select("cell", "key", "size", "bits").mapInArrow(_told_apart(num, den), "cell long, part long, key long"), "jaccard-close")
    cells = close.select(F.xxhash64("cell", "part").alias("cell"), "key").join(sets.select("key", "tokens"), "key")
    cells = cells.repartition(parts, "cell").sortWithinPartitions("cell", "key")
    links = cells.select("cell", "key", "tokens").mapInArrow(_compared(num, den), "a long, b long")
    # Written, so that the join with many equal sets below can be split.
    root = stored(components(links), "jaccard-roots")
    discard(groups, sizes, sets, close)
    known = members.join(root.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.when(F.col("n_shingles") > 0, F.coalesce("root", "key")))
    return known.select("id", "text_hash", "n_shingles", "root")


def jaccard_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row of ``df``: id, n_shingles, component_id.

    Two rows link when the Jaccard similarity of their sets of ``width``-word
    shingles is at least num/den; ``component_id`` is the least id reachable by
    links, its own included.

    A text with fewer words is one shingle; a null text or one without words has
    no shingle, links with nothing and is its own component.  Equal sets, repeated
    ids and repeated rows included, are linked.  A null id never names a component
    unless all its ids are null; other columns are not read.  An empty table gives
    no row.
    """
    known = _classes(df, id_col, text_col, width, num, den)
    # Written first, so that the rows of a large component can be split in the join.
    least = stored(known.filter("root is not null").groupBy("root").agg(F.min("id").alias("least")), "jaccard-least")
    out = known.join(least, "root", "left")
    return out.select("id", "n_shingles", F.coalesce("least", "id").alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``df`` with one row of each component of :func:`jaccard_classes`: that of least id.

    Of rows with equal id the one with the least hash of its text stays; rows
    equal in id and text are one.  Rows without shingles link with nothing and
    stay.  All columns keep their names and values.
    """
    known = _classes(df, id_col, text_col, width, num, den)
    found = known.filter("root is not null").groupBy("root").agg(F.min(first_row()).alias("of")).select("of.id", "of.text_hash")
    alone = known.filter("root is null").select("id", "text_hash")
    keys = [F.xxhash64("id", "text_hash").alias("_k1"), F.xxhash64(F.lit("row"), "text_hash", "id").alias("_k2")]
    kept = found.unionByName(alone).select(*keys)
    text = F.col("row").getField(text_col).cast("string")
    rows = df.select(F.struct(*[column(c) for c in df.columns]).alias("row"))
    rows = rows.select("row", F.col("row").getField(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash")).select("row", *keys)
    return rows.join(kept, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select("row.*")


def _tokens(docs: DataFrame, members: DataFrame, keys: DataFrame, width: int) -> DataFrame:
    """key and packed tokens of the sets of ``keys``, each made anew from one of its documents (or equal rows)."""
    one = members.groupBy("key").agg(F.min(first_row()).alias("of")).join(keys, "key", "left_semi")
    one = one.select("key", F.col("of.id").alias("one_id"), F.col("of.text_hash").alias("one_hash"))
    texts = docs.join(one, (F.col("text_hash") == F.col("one_hash")) & F.col("id").eqNullSafe(F.col("one_id")))
    return stored(texts.select("key", "text").mapInArrow(_sets(width), "key long, tokens binary, bits binary"), "jaccard-sets")


def spanning_links(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of some sets (ascending tokens): enough for all that link, directly or not."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    if n == 2:
        inside = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if inside * (num + den) >= int(size.sum()) * num else []
    tokens, local, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size)
    several = times[local] > 1  # tokens of one set alone are in no intersection
    owner, local = owner[several], local[several]
    _, local = np.unique(local, return_inverse=True)
    inside = np.zeros((n, n), np.float32)
    width = max(1, (8 << 20) // n)
    for a in range(0, int(local.max()) + 1 if len(local) else 0, width):
        part = (local >= a) & (local < a + width)
        has = np.zeros((n, min(width, int(local.max()) + 1 - a)), np.float32)
        has[owner[part], local[part] - a] = 1
        inside += has @ has.T
    good = inside.astype(np.int64) * (num + den) >= (size[:, None] + size[None, :]) * num
    out, left = [], np.ones(n, bool)
    for start in range(n):
        if not left[start]:
            continue
        left[start], front = False, [start]
        while front:
            i = front.pop()
            for j in np.flatnonzero(good[i] & left).tolist():
                left[j] = False
                out.append((i, j))
                front.append(j)
    return out


def bitmap(tokens: np.ndarray) -> bytes:
    """A set's tokens hashed to as many bits as it has tokens, or up to twice as many (64 at least)."""
    width = max(64, 1 << max(0, len(tokens) - 1).bit_length())
    has = np.zeros(width, bool)
    has[((tokens >> np.uint64(20)) & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(has).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """A bitmap as words, folded to ``size`` bytes."""
    return np.bitwise_or.reduce(np.frombuffer(bits, np.uint8).reshape(-1, size), axis=0).view(np.uint64)


def close_parts(sizes: list[int], bits: list[bytes], num: int, den: int) -> np.ndarray:
    """Numbers the sets so that those that may be similar, directly or through others, have one number.

    Bits that two bitmaps don't share are tokens that the sets don't share, so a
    pair with more of them than its sizes allow is not similar, for certain.
    """
    n, size = len(sizes), np.array(sizes)
    width = min(map(len, bits))
    words = np.array([folded(b, width) for b in bits])
    out, left = np.full(n, -1), np.ones(n, bool)
    for start in range(n):
        if not left[start]:
            continue
        left[start], out[start], front = False, start, [start]
        while front:
            i = front.pop()
            others = np.flatnonzero(left)
            both = size[i] + size[others]
            most = both - 2 * -(-num * both // (num + den))
            apart = np.bitwise_count(words[i] ^ words[others]).sum(axis=1, dtype=np.int64)
            near = others[(apart <= most) & (np.minimum(size[i], size[others]) * den >= np.maximum(size[i], size[others]) * num)]
            left[near] = False
            out[near] = start
            front += near.tolist()
    return out


def _grouped(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each cell, in order; equal rows of one key come one after another and count once."""
    at, rows = None, []
    for batch in batches:
        for cell, *row in zip(batch.column("cell").to_pylist(), *(batch.column(c).to_pylist() for c in columns), strict=True):
            if cell != at:
                if len(rows) > 1:
                    yield at, rows
                at, rows = cell, []
            if not rows or row[0] != rows[-1][0]:
                rows.append(row)
    if len(rows) > 1:
        yield at, rows
    release_memory()


def _told_apart(num: int, den: int):
    """Of each cell the sets that may be similar to another one: cell, part, key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int, int]] = []
        for cell, rows in _grouped(batches, ("key", "size", "bits")):
            keys = [r[0] for r in rows]
            parts = close_parts([r[1] for r in rows], [r[2] for r in rows], num, den)
            times = np.bincount(parts, minlength=len(rows))
            found += [(cell, keys[p], k) for k, p in zip(keys, parts.tolist(), strict=True) if times[p] > 1]
            if len(found) > 10_000:
                yield pa.RecordBatch.from_pydict(dict(zip(("cell", "part", "key"), map(list, zip(*found, strict=True)), strict=True)))
                found = []
        if found:
            yield pa.RecordBatch.from_pydict(dict(zip(("cell", "part", "key"), map(list, zip(*found, strict=True)), strict=True)))

    return run


def _compared(num: int, den: int):
    """Links of each cell's sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for _, rows in _grouped(batches, ("key", "tokens")):
            found += [(rows[i][0], rows[j][0]) for i, j in spanning_links([unpacked_set(r[1]) for r in rows], num, den)]
            if len(found) > 10_000:
                yield pa.RecordBatch.from_pydict({"a": [x[0] for x in found], "b": [x[1] for x in found]})
                found = []
        if found:
            yield pa.RecordBatch.from_pydict({"a": [x[0] for x in found], "b": [x[1] for x in found]})

    return run
