"""Removal of long repeated byte strings by distributed suffix sorting.

Every 200-byte string holds one anchor, picked by its content alone (the least
hashed 32-byte string in it), so equal strings have equal anchors at equal
places and only suffixes at anchors need sorting.  Anchors whose first 32 bytes
occur once are done with.  The other suffixes are sorted where they are,
front-coded (bytes shared with the suffix before are not sent again) and
exchanged as sorted runs; each receiver merges its runs in a loser tree that
keeps every head's common prefix with the last suffix given out and compares
only beyond it.  The merged order and its common prefixes, with those of the
bytes before the anchors, tell for every string at once whether it recurs.

Suffixes are dealt to receivers by a hash of their anchor: each receiver's order is
whole, but there is no one order of all.  An anchor that very many different texts
stand around is hot: no receiver gets all its suffixes.  Their strings are told by
counting hashes instead, first of the parts that a band of strings has in common,
then, where those recur, of the strings themselves.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, stored

#: Bytes of an anchor.
ANCHOR = 32
#: Contexts of an anchor in one run, and in one receiver, beyond which it is hot; strings of a band.
LOCAL, HOT, BAND = 64, 4096, 24
#: Bytes whose anchors are picked at once, and of context that make up a run.
BUFFER, RUN = 1 << 18, 24 << 20

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes at each place of ``raw``."""
    n = len(raw) - 7
    words = np.empty(n, np.uint64)
    for s in range(8):
        words[s::8] = np.frombuffer(raw[s : s + (n - s + 7) // 8 * 8].tobytes(), "<u8")
    m = len(raw) - ANCHOR + 1
    h = words[:m] * _C[0]
    for k in range(1, ANCHOR // 8):
        h ^= h >> np.uint64(31)
        h += words[8 * k : 8 * k + m]
        h *= _C[k]
    h ^= h >> np.uint64(32)
    h *= _C[0]
    h ^= h >> np.uint64(29)
    return h


def anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``length`` bytes in ``raw``: hash, place, first and last string start."""
    h = _hashes(raw)
    m, w = len(h), length - ANCHOR + 1
    key = (h & _HIGH) | np.arange(m, dtype=np.uint64)
    cells = np.full(-(-m // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    cells[:m] = key
    cells = cells.reshape(-1, w)
    ahead = np.minimum.accumulate(cells, axis=1).ravel()
    behind = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: m - w + 1], ahead[w - 1 : m])
    place = (least & ~_HIGH).astype(np.int64)
    edge = np.flatnonzero(np.diff(place, prepend=-1))
    return h[place[edge]], place[edge], edge, np.append(edge[1:], len(place)) - 1


def document_anchors(docs: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For buffers of documents: document number, hash, place in it, first and last string start.

    Short documents share a buffer and strings over their bounds are left out;
    long ones are cut into pieces that overlap by ``length - 1`` bytes.
    """

    def picked(parts: list[tuple[int, int, bytes]]):
        raw = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
        hashed, place, first, last = anchors(raw, length)
        ends = np.cumsum([len(p[2]) for p in parts])
        starts = ends - [len(p[2]) for p in parts]
        of = np.searchsorted(ends, first, side="right")
        # A run of strings with one anchor may reach over documents: cut it at the last string of each.
        final = ends[of] - length
        again = np.flatnonzero(last > final)
        hashed, place, of, first, last = (np.concatenate([x, y]) for x, y in zip((hashed, place, of, first, np.minimum(last, final)), _later(again, hashed, place, last, of, ends, starts, length), strict=True))
        good = (first <= last) & (place >= first)
        hashed, place, of, first, last = (x[good] for x in (hashed, place, of, first, last))
        number, origin = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
        shift = origin[of] - starts[of]
        return number[of], hashed, place + shift, first + shift, last + shift

    parts, total = [], 0
    for k, d in enumerate(docs):
        if len(d) < length:
            continue
        for a in range(0, len(d) - length + 1, BUFFER):
            piece = d[a : a + BUFFER + length - 1]
            parts.append((k, a, piece))
            total += len(piece)
            if total >= BUFFER:
                yield picked(parts)
                parts, total = [], 0
    if parts:
        yield picked(parts)


def _later(again, hashed, place, last, of, ends, starts, length):
    """The parts of runs of strings that lie in documents after the run's first one."""
    out = [[], [], [], [], []]
    for r in again.tolist():
        k = of[r] + 1
        while k < len(ends) and starts[k] <= last[r]:
            for x, v in zip(out, (hashed[r], place[r], k, starts[k], min(last[r], ends[k] - length)), strict=True):
                x.append(v)
            k += 1
    return [np.array(x, t) for x, t in zip(out, (np.uint64, np.int64, np.int64, np.int64, np.int64), strict=True)]


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    while a[known : known + 16] == b[known : known + 16]:
        known += 16
    while a[known] == b[known]:
        known += 1
    return known


def adjacent(strings: list[bytes]) -> list[int]:
    """Common prefix of each of some sorted strings with the one before; 0 for the first."""
    return [0, *[common(a, b, 0) for a, b in zip(strings, strings[1:], strict=False)]] if strings else []


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merges sorted runs with their common prefixes: (run, place) in order, and common prefixes.

    A loser tree whose nodes hold a run each.  The head of a run is known to
    share ``known`` bytes with the last string given out; of two heads the one
    that shares more is the smaller, and only heads that share as much are
    compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    strings = [r[0] for r in runs] + [[] for _ in range(k - len(runs))]
    prefixes = [r[1] for r in runs] + [[] for _ in range(k - len(runs))]
    at, size = [0] * k, [len(s) for s in strings]
    known = [0 if n else -1 for n in size]  # -1: the run is used up
    head = [s[0] if s else b"" for s in strings]
    tree = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        ka, kb = known[a], known[b]
        if ka > kb:
            return a, b
        if ka < kb:
            return b, a
        if ka < 0:
            return a, b
        x, y = head[a], head[b]
        c = common(x, y, ka)
        if c == len(x) or (c < len(y) and x[c] < y[c]):
            known[b] = c
            return a, b
        known[a] = c
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, loser = play(build(2 * node), build(2 * node + 1))
        tree[node] = loser
        return winner

    winner = build(1) if k > 1 else 0
    order, out = [], []
    while known[winner] >= 0:
        i = at[winner]
        order.append((winner, i))
        out.append(known[winner])
        at[winner] = i = i + 1
        if i < size[winner]:
            head[winner] = strings[winner][i]
            known[winner] = prefixes[winner][i]
        else:
            known[winner] = -1
        node = (winner + k) >> 1
        while node:
            other = tree[node]
            ka, kb = known[winner], known[other]
            if ka < kb:
                tree[node], winner = winner, other
            elif ka == kb and ka >= 0:
                winner, tree[node] = play(winner, other)
            node >>= 1
    return order, out


#: One suffix of a run: common prefix, bytes of right and left, least and most bytes before the anchor, told already, document key, place.
ITEM = struct.Struct("<BBBBBBqqq")


def coded_run(items: list[tuple]) -> bytes:
    """Items (right, left, low, high, told, k1, k2, place), sorted by right, front-coded."""
    parts, before = [], b""
    for right, left, low, high, told, k1, k2, place in items:
        c = common(before, right, 0)
        parts.append(ITEM.pack(c, len(right), len(left), low, high, told, k1, k2, place))
        parts.append(right[c:])
        parts.append(left)
        before = right
    return b"".join(parts)


def decoded_run(data: bytes) -> tuple[list[bytes], list[int], list[tuple]]:
    """Suffixes, common prefixes, and (left, low, high, told, k1, k2, place) of a run."""
    strings, prefixes, rest, at, before = [], [], [], 0, b""
    while at < len(data):
        c, n, m, low, high, told, k1, k2, place = ITEM.unpack_from(data, at)
        at += ITEM.size
        before = before[:c] + data[at : at + n - c]
        at += n - c
        strings.append(before)
        prefixes.append(c)
        rest.append((data[at : at + m], low, high, told, k1, k2, place))
        at += m
    return strings, prefixes, rest


def recurring(prefixes: np.ndarray, lefts: list[bytes], low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    """For suffixes in order, whether the string that starts ``d`` bytes before the anchor recurs, by d.

    Two such strings are equal if ``length - d`` bytes from the anchor and ``d``
    bytes before it are: if the suffixes are in one class of common prefixes that
    long, and the reversed bytes before them too.
    """
    n, most = len(prefixes), length - ANCHOR
    back = sorted(range(n), key=[x[::-1] for x in lefts].__getitem__)
    ordered = [lefts[i][::-1] for i in back]
    shared = np.array(adjacent(ordered), np.int64)
    back = np.array(back, np.int64)
    out = np.zeros((n, most + 1), bool)
    left_class = np.empty(n, np.int64)
    for d in range(most + 1):
        own = np.flatnonzero((low <= d) & (d <= high))
        if len(own) < 2:
            continue
        right_class = np.cumsum(prefixes < length - d)
        left_class[back] = np.cumsum(shared < d)
        key = right_class[own] * (n + 1) + left_class[own]
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        twice = np.zeros(len(own), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        out[own, d] = twice
    return out


SHARED = "k1 long, k2 long, packed long"
RUNS = "part int, run binary, mark boolean, hot binary, k1 long, k2 long, first long, last long"
TOLD = "hot binary, k1 long, k2 long, first long, last long"
BANDS = "b1 long, b2 long, k1 long, k2 long, start long, strings binary"


def _anchor_rows(length: int):
    """Rows of anchors; ``deal`` is what they are dealt out by.

    An anchor that a batch has several times is repeated for certain: its rows
    are dealt out evenly, as told, and one that isn't passed on (place -1) goes
    with the anchor, to meet those of other batches.  So a hot anchor is few rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            found = [(hashed.view(np.int64), of, place << 16 | (place - last) << 8 | (place - first)) for of, hashed, place, first, last in document_anchors(batch.column("text").to_pylist(), length)]
            if not found:
                continue
            anchor, of, packed = (np.concatenate(x) for x in zip(*found, strict=True))
            _, one, back, times = np.unique(anchor, return_index=True, return_inverse=True, return_counts=True)
            told = times[back] > 1
            one = one[times > 1]
            spread = (k1[of] ^ packed * np.int64(0x9E3779B97F4A7C1)) | np.int64(1)
            yield pa.RecordBatch.from_pydict({
                "deal": np.concatenate([np.where(told, spread, anchor), anchor[one]]),
                "told": pa.array(np.concatenate([told, np.zeros(len(one), bool)])),
                "k1": np.concatenate([k1[of], k1[of][one]]), "k2": np.concatenate([k2[of], k2[of][one]]),
                "packed": np.concatenate([packed, np.full(len(one), -1)]),
            })

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from .common import slices

    return slices(batches, "text", 4 << 20)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Told rows, and of the others, in anchor order, those whose anchor another row has too.

    One row is held from batch to batch.
    """
    names = ("k1", "k2", "packed")
    held, passed_on = None, False
    for batch in batches:
        told = batch.column("told").to_numpy(zero_copy_only=False)
        if told.any():
            yield batch.filter(batch.column("told")).select(names)
        rows = [batch.column(c).to_numpy()[~told] for c in ("deal", *names)]
        if not len(rows[0]):
            continue
        if held is not None:
            rows = [np.concatenate([[x], y]) for x, y in zip(held, rows, strict=True)]
        same = rows[0][1:] == rows[0][:-1]
        several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        passed = bool(several[-1]) or (len(rows[0]) == 1 and passed_on)
        several[0] &= not passed_on
        several &= rows[3] >= 0
        if several.any():
            yield pa.RecordBatch.from_pydict({c: x[several] for c, x in zip(names, rows[1:], strict=True)})
        held, passed_on = [x[-1] for x in rows], passed


def _sorted_runs(length: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: dict[tuple, list] = {}
        held = 0

        def given() -> Iterator[pa.RecordBatch]:
            # Equal contexts met in this task recur: all but one are told at once, and one is sent for the others.
            times = Counter(right[:ANCHOR] for right, _, _, _ in items)
            hot = {x for x, n in times.items() if n > LOCAL}
            place_of = lambda x: int.from_bytes(hashlib.blake2b(x, digest_size=6).digest(), "little") % parts
            by_part: dict[int, list[tuple]] = {}
            rows: list[tuple] = [(place_of(x), x, True, None, None, None, None, None) for x in hot]
            for (right, left, low, high), owners in items.items():
                if len(owners) > 1:  # these only pass through: dealt evenly
                    rows += [(k1 % parts, None, False, None, k1, k2, p - high, p - low) for k1, k2, p in owners]
                item = right, left, low, high, len(owners) > 1, *owners[0]
                if right[:ANCHOR] in hot:
                    rows.append((owners[0][0] % parts, None, False, coded_run([item]), None, None, None, None))
                else:
                    by_part.setdefault(place_of(right[:ANCHOR]), []).append(item)
            rows += [(part, coded_run(sorted(x)), False, None, None, None, None, None) for part, x in by_part.items()]
            kinds = (pa.int32(), pa.binary(), pa.bool_(), pa.binary(), *[pa.int64()] * 4)
            for k in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[k : k + 4096], strict=True), kinds, strict=True)], [x.split()[0] for x in RUNS.split(", ")])

        for batch in _cut(batches):
            for k1, k2, text, places in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text", "places")), strict=True):
                for packed in places:
                    place, low, high = packed >> 16, packed >> 8 & 255, packed & 255
                    context = text[place : place + length - low], text[place - high : place], low, high
                    if context in items:
                        items[context].append((k1, k2, place))
                    else:
                        items[context] = [(k1, k2, place)]
                        held += length + high - low + 200
                    if held > RUN:
                        yield from given()
                        items, held = {}, 0
        if items:
            yield from given()

    return run


def without(run: tuple[list[bytes], list[int], list[tuple]], hot: set[bytes]) -> tuple[tuple, list[tuple]]:
    """A decoded run without the suffixes at hot anchors, and those as items."""
    strings, prefixes, rest, gone, least = [], [], [], [], ANCHOR * 8
    for x, c, r in zip(*run, strict=True):
        least = min(least, c)
        if x[:ANCHOR] in hot:
            gone.append((x, *r))
        else:
            strings.append(x)
            prefixes.append(least if strings[1:] else 0)
            rest.append(r)
            least = ANCHOR * 8
    return (strings, prefixes, rest), gone


def _merged(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, hot, times = None, [], set(), Counter()

        def rows_of(gone: list[tuple]) -> Iterator[pa.RecordBatch]:
            if gone:
                none = pa.nulls(len(gone), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([coded_run([x]) for x in gone], pa.binary()), none, none, none, none], [x.split()[0] for x in TOLD.split(", ")])

        def given() -> Iterator[pa.RecordBatch]:
            decoded = []
            for r in held:
                kept, gone = without(r, hot)
                yield from rows_of(gone)
                decoded.append(kept)
            order, prefixes = merge([(d[0], d[1]) for d in decoded])
            rest = [decoded[r][2][i] for r, i in order]
            if not rest:
                return
            low, high, told = (np.array([x[k] for x in rest], np.int64) for k in (1, 2, 3))
            found = recurring(np.array(prefixes, np.int64), [x[0] for x in rest], low, high, length)
            found[told == 1] = False  # these have been told where they were sorted
            edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            who, start = np.nonzero(edge == 1)
            _, stop = np.nonzero(edge == -1)
            if len(who):
                k1, k2, place = (np.array([x[k] for x in rest], np.int64)[who] for k in (4, 5, 6))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(who), pa.binary()), *map(pa.array, (k1, k2, place - stop + 1, place - start))], [x.split()[0] for x in TOLD.split(", ")])

        for batch in batches:
            through = batch.filter(batch.column("run").is_null())
            if through.num_rows:
                yield through.select(["hot", "k1", "k2", "first", "last"])
            own = batch.filter(batch.column("run").is_valid())
            for p, r, mark in zip(own.column("part").to_pylist(), own.column("run").to_pylist(), own.column("mark").to_pylist(), strict=True):
                if p != part:
                    if held:
                        yield from given()
                    part, held, hot, times = p, [], set(), Counter()
                if mark:  # come first
                    hot.add(r)
                    continue
                kept, gone = without(decoded_run(r), hot)
                yield from rows_of(gone)
                times.update(x[:ANCHOR] for x in kept[0])
                hot |= {x[:ANCHOR] for x in kept[0] if times[x[:ANCHOR]] > HOT}
                held.append(kept)
        if held:
            yield from given()

    return run


def _bands(length: int):
    """For each suffix at a hot anchor its strings in bands of ``BAND``: the hash of what a band's strings have in common, and theirs."""

    def digest(data: bytes) -> bytes:
        return hashlib.blake2b(data, digest_size=16).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item in batch.column("hot").to_pylist():
                (right,), _, ((left, low, high, _, k1, k2, place),) = decoded_run(item)
                for d in range(low // BAND * BAND, high + 1, BAND):
                    first, last = max(d, low), min(d + BAND - 1, high)
                    # Whatever string of the band two contexts share, they share the d bytes before the anchor and those up to the band's least end.
                    name = digest(bytes([d // BAND]) + left[high - d :] + right[: max(ANCHOR, length - d - BAND + 1)])
                    strings = b"".join(digest(left[high - e :] + right[: length - e]) for e in range(first, last + 1))
                    rows.append((*struct.unpack("<qq", name), k1, k2, place - first, strings))
            if rows:
                kinds = (*[pa.int64()] * 5, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in BANDS.split(", ")])

    return run


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each string of some bands: its hash, its document and start."""
    for batch in batches:
        data = batch.column("strings").to_pylist()
        n = np.array([len(x) // 16 for x in data], np.int64)
        hashed = np.frombuffer(b"".join(data), "<i8").reshape(-1, 2)
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        alone, k1, k2, start = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), n) for c in ("alone", "k1", "k2", "start"))
        yield pa.RecordBatch.from_arrays([*map(pa.array, (alone.astype(bool), np.ascontiguousarray(hashed[:, 0]), np.ascontiguousarray(hashed[:, 1]), k1, k2, start - nth))], ["alone", "b1", "b2", "k1", "k2", "start"])


def _hot_ranges(hot: DataFrame, length: int) -> DataFrame:
    """k1, k2, first, last of the strings at hot anchors that recur, by 128 bits of hash; no task gathers a group.

    Bands alike in all their strings recur whole, and one of them stands for the
    others; only the strings of bands that differ, but share what a band has in
    common, are looked at one by one.
    """
    whole = [F.xxhash64("strings").alias("w1"), F.xxhash64(F.lit("band"), "strings").alias("w2")]
    bands = stored(hot.mapInArrow(_bands(length), BANDS).select("*", *whole), "bands")
    key = ["b1", "b2", "w1", "w2"]
    kinds = stored(bands.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("k1", "k2", "start", "strings")).alias("one")), "band-kinds")
    alike = bands.join(stored(kinds.filter("n > 1").select(*key), "recurring"), key, "left_semi")
    told = alike.select("k1", "k2", (F.col("start") - F.octet_length("strings") / 16 + 1).cast("long").alias("first"), F.col("start").alias("last"))
    several = stored(kinds.groupBy("b1", "b2").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("b1", "b2"), "recurring")
    near = kinds.join(several, ["b1", "b2"], "left_semi").select((F.col("n") == 1).alias("alone"), "one.*")
    strings = stored(near.mapInArrow(_strings, "alone boolean, b1 long, b2 long, k1 long, k2 long, start long"), "strings")
    twice = stored(strings.groupBy("b1", "b2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("b1", "b2"), "recurring")
    # Those that stand for others have been told with them.
    single = strings.filter("alone").join(twice, ["b1", "b2"], "left_semi").select("k1", "k2", F.col("start").alias("first"), F.col("start").alias("last"))
    return told.unionByName(single)


def removed_spans(n: int, firsts: list[int], lasts: list[int], length: int) -> np.ndarray:
    """Maximal removed byte runs (start, end), from ranges of recurring string starts."""
    if not firsts:
        return np.empty((0, 2), np.int64)
    a = np.array(firsts, np.int64)
    b = np.array(lasts, np.int64) + length
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    opens = np.concatenate([[True], a[1:] > b[:-1]])
    return np.column_stack([a[opens], b[np.append(np.flatnonzero(opens)[1:] - 1, len(b) - 1)]])


def _kept(length: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                spans = removed_spans(len(text), [r["first"] for r in ranges or ()], [r["last"] for r in ranges or ()], length)
                kept, at = [], 0
                for a, b in spans.tolist():
                    kept.append(text[at:a])
                    at = b
                whole = b"".join([*kept, text[at:]])
                out["n_bytes"].append(len(text))
                out["n_removed"].append(len(text) - len(whole))
                out["n_spans"].append(len(spans))
                out["kept"].append(hashlib.sha256(whole).hexdigest() if digest else whole)
            kind = pa.string() if digest else pa.binary()
            yield pa.RecordBatch.from_pydict({"id": batch.column("id")} | {k: pa.array(v, pa.int64() if k != "kept" else kind) for k, v in out.items()})

    return run


def drop_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, digest: bool = False) -> DataFrame:
    """Per row of ``df``: id, n_bytes, n_removed, n_spans, kept (binary; its SHA-256 with ``digest``).

    Removed is every byte covered by a string of ``length`` bytes that also
    starts anywhere else, in the same text or another (overlaps count), judged on
    the input.  ``length`` is 32 to 255.  Null text is empty; texts shorter
    than ``length`` are kept.  Every row is a text of its own: repeated rows and
    ids recur in one another and lose all bytes that strings cover.  Kept bytes
    may cut a character.  Other columns are not read; an empty table gives no row.

    The texts are exchanged for the contexts of repeated anchors and again for
    the cuts.  No receiver gets more than ``HOT`` contexts of one anchor from
    tasks that see ``LOCAL`` of them at most; hot anchors' strings are compared by
    128 bits of hash, all others byte by byte.
    """
    if not ANCHOR <= length <= 255:
        raise ValueError("length must be from 32 to 255")
    spark = df.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    rowid = column(id_col).cast("long")
    docs = df.select(rowid.alias("id"), text.cast("binary").alias("text"), F.xxhash64(rowid, text).alias("k1"), F.xxhash64(F.lit("row"), text, rowid).alias("k2"))

    found = docs.select("k1", "k2", "text").mapInArrow(_anchor_rows(length), "deal long, told boolean, k1 long, k2 long, packed long")
    shared = found.repartition(parts // 4, "deal").sortWithinPartitions("deal").mapInArrow(_repeated, SHARED)
    places = shared.groupBy("k1", "k2").agg(F.collect_list("packed").alias("places"))
    runs = docs.join(places, ["k1", "k2"]).select("id", "k1", "k2", "text", "places").mapInArrow(_sorted_runs(length, parts), RUNS)
    dealt = runs.repartition(parts // 4, "part").sortWithinPartitions("part", F.col("mark").desc())
    found = stored(dealt.mapInArrow(_merged(length), TOLD), "recurring-strings")
    told, hot = found.filter("hot is null").select("k1", "k2", "first", "last"), found.filter("hot is not null").select("hot")
    if not hot.isEmpty():
        told = told.unionByName(_hot_ranges(hot, length))
    ranges = told.groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    both = docs.join(ranges, ["k1", "k2"], "left").select("id", "k1", "k2", "text", "ranges")
    return both.mapInArrow(_kept(length, digest), f"id long, n_bytes long, n_removed long, n_spans long, kept {'string' if digest else 'binary'}")
