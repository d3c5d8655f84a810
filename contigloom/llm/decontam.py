"""Benchmark decontamination: q-gram lemma filtering in diagonal bands, then banded alignment.

Texts are compared in lower case with every run of ASCII characters other than letters and digits as one space. An item is met where one
of its windows (window characters from every place on; shorter items are one window) lies in a document within the edit budget, share * window.
Two strings of w characters within k edits share w - q + 1 - k * q q-grams at least (the q-gram lemma), on diagonals at most k apart; q is
chosen by item so that this is one at least. The hits of a document and an item are counted in overlapping bands of 2k + 2 diagonals, one of which holds
all diagonals of a match; bands and then windows with fewer hits are dropped, and what remains is aligned inside its band. Items of fewer than
SHORT characters allow no edits: they are met where their words stand consecutively.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.llm.chunks import slices
from contigloom.runtime import drop, keep, ship, tidy

Q, WINDOW, SHARE, SHORT = 10, 64, 0.07, 10
TABLE_BITS = 22
#: q-grams are hashed, hits are counted, and windows are aligned so many at a time, however long a text is and however often a q-gram recurs.
SLICE, HITS, UNITS = 1 << 19, 1 << 20, 4096
_NORMAL = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_SPACES = re.compile(rb"  +")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MIDDLE = 1 << 31


def normal(text: bytes) -> bytes:
    return _SPACES.sub(b" ", text.translate(_NORMAL)).strip()


def grams(x: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of the q-byte windows of a byte array (q is 1 to 16)."""
    n = len(x) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    word, wide = x.astype(np.uint64), 1
    while 2 * wide <= min(q, 8):
        word = word[:-wide] | (word[wide:] << np.uint64(8 * wide))
        wide *= 2
    h = word[:n] * _A
    h ^= word[q - wide : q - wide + n] * _B
    h ^= h >> np.uint64(32)
    h *= _A
    return h


def banded_edits(a: np.ndarray, b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(fewest edits, diagonal of the end) that turn the rows of a into some substring of the rows of b on the diagonals 0 to width - 1.

    b has len(a) + width places a row; places outside the text hold 256 and count as unequal to all, which is never
    cheaper than to leave out the character that stands against them.
    """
    steps = np.arange(width, dtype=np.int16)
    row = np.zeros((len(a), width), np.int16)  # a may start on any diagonal
    for i in range(a.shape[1]):
        new = row + (b[:, i : i + width] != a[:, i : i + 1])
        np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    end = row.argmin(1)
    return row[np.arange(len(row)), end], end


class Grams:
    """The q-grams of some items: a bit table for a first test, sorted hashes with places for the second."""

    def __init__(self, q: int, which: list[int], items: list[np.ndarray]):
        self.q, parts = q, [grams(items[i], q) for i in which]
        h = np.concatenate(parts)
        item = np.repeat(np.array(which, np.int32), [len(p) for p in parts])
        place = np.concatenate([np.arange(len(p), dtype=np.int32) for p in parts])
        order = np.argsort(h, kind="stable")
        self.hashes, start = np.unique(h[order], return_index=True)
        self.start, self.end = start.astype(np.int32), np.append(start[1:], len(h)).astype(np.int32)
        self.item, self.place = item[order], place[order]
        self.table = np.zeros(1 << TABLE_BITS, np.bool_)
        self.table[self.hashes >> np.uint64(64 - TABLE_BITS)] = True
        self.longest = max(len(items[i]) for i in which)

    def places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in x, number of the q-gram) of all q-grams of x that some item has."""
        places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for low in range(0, len(x), SLICE):
            h = grams(x[low : low + SLICE + self.q - 1], self.q)
            at = np.flatnonzero(self.table[h >> np.uint64(64 - TABLE_BITS)])
            g = np.searchsorted(self.hashes, h[at])
            g[g == len(self.hashes)] = 0
            same = self.hashes[g] == h[at]
            places.append(at[same] + low)
            found.append(g[same])
        return np.concatenate(places), np.concatenate(found)


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[cut], np.add.reduceat(n, cut) if len(cut) else n


class Index:
    """A block of items, ready to be met: windows has (characters, edits, least hits, starts) of each item, None without characters."""

    def __init__(self, ids: list, texts: list[bytes]):
        self.ids, self.items = ids, [np.frombuffer(normal(t), np.uint8) for t in texts]
        self.windows, self.q = [], np.zeros(len(ids), np.int64)
        by_q, self.short = defaultdict(list), defaultdict(list)
        for i, x in enumerate(self.items):
            w = min(WINDOW, len(x))
            k = int(SHARE * w)
            if w < SHORT:
                self.windows.append((w, 0, 1, range(1)) if w else None)
                if w:
                    self.short[x.tobytes()].append(i)
                continue
            q = min(Q, w // (k + 1))
            self.q[i] = q
            self.windows.append((w, k, w - q + 1 - k * q, range(len(x) - w + 1)))
            by_q[q].append(i)
        self.edits = np.array([w[1] if w else 0 for w in self.windows], np.int64)
        self.least = np.array([w[2] if w else 0 for w in self.windows], np.int64)
        self.grams = [Grams(q, which, self.items) for q, which in sorted(by_q.items())]
        self.word_counts = sorted({k.count(b" ") + 1 for k in self.short})

    def bands(self, own: Grams, x: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, item, band) with hits enough for a window. The hits are expanded slice by slice and only their counts by band are held, of
        bands that later places can still reach; the band of a diagonal is its number over k + 1, and each hit counts in the next lower one too."""
        at, g = own.places(x)
        size = (own.end[g] - own.start[g]).astype(np.int64)
        total = np.cumsum(size)
        low, key, n = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        while low < len(at):
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + HITS, "right")))
            m = size[low:high]
            rows = np.repeat(own.start[g[low:high]] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
            place = np.repeat(at[low:high], m)
            doc = np.searchsorted(starts, place, "right") - 1
            item = own.item[rows].astype(np.int64)
            band = (place - starts[doc] - own.place[rows] + _MIDDLE) // (self.edits[item] + 1)
            new = (doc * len(self.items) + item) * (1 << 32) + band
            key, n = _summed(np.concatenate([key, new, new - 1]), np.concatenate([n, np.ones(2 * len(new), np.int64)]))
            item, band = (key >> 32) % len(self.items), key & ((1 << 32) - 1)
            doc = (key >> 32) // len(self.items)
            over = np.ones(len(key), bool)
            if high < len(at):  # a band that the next place can't reach any more is counted out
                reach = (band + 2) * (self.edits[item] + 1) - _MIDDLE + own.longest + starts[doc]
                over = reach < at[high]
            enough = over & (n >= self.least[item])
            yield from zip(doc[enough].tolist(), item[enough].tolist(), band[enough].tolist())
            key, n = key[~over], n[~over]
            low = high

    def matches(self, docs: list[bytes]) -> list[tuple[int, int, int, int, int, int]]:
        """(document, item, windows met, fewest edits, first and last byte of the normal text) of the pairs that are met; the bytes are those of the bands around the windows."""
        texts = [normal(t) for t in docs]
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        x = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)  # no q-gram of an item holds a line end
        out = []
        for own in self.grams:
            met: dict[tuple[int, int], Met] = {}
            waiting: list[tuple[Met, int, np.ndarray, np.ndarray, np.ndarray]] = []
            held = 0
            for d, i, band in self.bands(own, x, starts):
                w, k, need, windows = self.windows[i]
                pair = met.get((d, i))
                if pair is None:
                    pair = met[d, i] = Met(len(windows), k)
                if not pair.open:
                    continue
                width = 2 * (k + 1)
                low, text, a = band * (k + 1) - _MIDDLE, x[starts[d] : starts[d + 1] - 1], self.items[i]
                for s in range(0, len(windows), SLICE // 8):
                    part = a[s : s + SLICE // 8 + w - 1]
                    b = np.full(len(part) + width, 256, np.int16)
                    left = low + s  # the place in the text of the lowest diagonal
                    inner = text[max(0, left) : max(0, left + len(b))]
                    b[max(0, -left) : max(0, -left) + len(inner)] = inner
                    same = np.cumsum(np.pad(sliding_window_view(b, len(part))[:width] == part, ((0, 0), (1, 0))), axis=1, dtype=np.int32)
                    hits = np.concatenate([[0], np.cumsum((same[:, self.q[i] :] - same[:, : -self.q[i]] == self.q[i]).sum(0))])
                    n = len(part) - w + 1
                    exact = same[:, w:] - same[:, :n] == w
                    for j in np.flatnonzero(exact.any(1)).tolist():
                        pair.add(s + np.flatnonzero(exact[j]), 0, left + j - s, w, len(text))
                    count = hits[w - self.q[i] + 1 :][:n] - hits[:n]
                    todo = np.flatnonzero((count >= need) & (pair.edits[s : s + n] > 0))
                    for u in range(0, len(todo), UNITS):
                        some = todo[u : u + UNITS]
                        waiting.append((pair, left - s, some + s, sliding_window_view(part, w)[some], sliding_window_view(b, w + width)[some], len(text)))
                        held += len(some)
                        if held >= UNITS:
                            _align(waiting)
                            waiting, held = [], 0
            _align(waiting)
            out += [(d, i, int((pair.edits <= pair.most).sum()), int(pair.edits.min()), pair.first, pair.last) for (d, i), pair in met.items() if pair.edits.min() <= pair.most]
        for d, text in enumerate(texts) if self.short else ():
            words, padded = text.split(b" "), b" " + text + b" "
            for n in self.word_counts:
                for key in self.short.keys() & {b" ".join(words[j : j + n]) for j in range(len(words) - n + 1)}:
                    first, last = padded.find(b" " + key + b" "), padded.rfind(b" " + key + b" ") + len(key)
                    out += [(d, i, 1, 0, first, last) for i in self.short[key]]
        return out


class Met:
    """What is known of a document and an item: the fewest edits of each window."""

    def __init__(self, windows: int, most: int):
        self.edits, self.most, self.first, self.last = np.full(windows, most + 1, np.int16), most, 1 << 62, 0

    @property
    def open(self) -> bool:
        """Whether a window may yet be met with fewer edits."""
        return bool(self.edits.any())

    def add(self, windows: np.ndarray, edits, diagonal: int, w: int, end: int) -> None:
        fine = np.broadcast_to(edits, windows.shape) <= self.most
        if fine.any():
            windows, edits = windows[fine], np.broadcast_to(edits, fine.shape)[fine]
            self.edits[windows] = np.minimum(self.edits[windows], edits)
            self.first = min(self.first, max(0, int(windows[0]) + diagonal))
            self.last = max(self.last, min(end, int(windows[-1]) + diagonal + w + self.most))


def _align(waiting: list[tuple]) -> None:
    """Align windows of one length and band width together."""
    groups = defaultdict(list)
    for x in waiting:
        groups[x[3].shape[1], x[4].shape[1]].append(x)
    for (w, n), rows in groups.items():
        edits, _ = banded_edits(np.concatenate([r[3] for r in rows]), np.concatenate([r[4] for r in rows]), n - w)
        at = 0
        for pair, diagonal, windows, a, _, end in rows:
            pair.add(windows, edits[at : at + len(a)], diagonal, w, end)
            at += len(a)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """One row per document and item met: key, item, n_windows (windows met), n_item_windows, edits (of the best window), first_byte and last_byte
    (of the normal text).

    The items travel to the tasks as broadcasts of block_bytes of text each; a larger benchmark is taken block by block, one pass over the documents
    for each, whose findings are written before the next, so a task holds one block whatever the benchmark's size. No shuffle and no joins. Null and empty texts meet nothing; items of fewer than SHORT
    characters in normal form are met word for word, null items and those without letters or digits never; equal items are all reported; repeated documents and null keys each get their own rows; other columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    body = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))
    kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"`{key}` {kind}, `{item}` {item_kind}, n_windows int, n_item_windows int, edits int, first_byte long, last_byte long"
    types = docs.limit(0).select(key).toArrow().schema, benchmark.limit(0).select(item).toArrow().schema

    def passed(block: list) -> DataFrame:
        held = spark.sparkContext.broadcast(block)
        kinds = types[0].field(0).type, types[1].field(0).type

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index([r[0] for r in held.value], [r[1] for r in held.value])
            for batch in batches:
                for b in slices(batch, 1, 4096):
                    found = index.matches(b.column(1).cast(pa.binary()).to_pylist())
                    if not found:
                        continue
                    keys = b.column(0).take(pa.array([m[0] for m in found])).cast(kinds[0])
                    items = pa.array([index.ids[m[1]] for m in found], kinds[1])
                    of_item = pa.array([len(index.windows[m[1]][3]) for m in found], pa.int32())
                    windows, edits, first, last = (pa.array([m[j] for m in found], t) for j, t in ((2, pa.int32()), (3, pa.int32()), (4, pa.int64()), (5, pa.int64())))
                    yield pa.RecordBatch.from_arrays([keys, items, windows, of_item, edits, first, last], names=[key, item, "n_windows", "n_item_windows", "edits", "first_byte", "last_byte"])

        return body.mapInArrow(tidy(run), schema)

    parts, last = [], None
    for block in blocks_of(benchmark, item, item_text, block_bytes):
        if last is not None:
            parts.append(keep(passed(last), "met"))
        last = block
    # the last pass, for most benchmarks the only one, is left to the caller
    return functools.reduce(DataFrame.unionByName, parts, passed(last))


def blocks_of(benchmark: DataFrame, item: str, item_text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """(id, text) of the items in blocks of about block_bytes of text; one empty block for an empty table."""
    block, size, some = [], 0, False
    for r in benchmark.select(item, item_text).filter(F.col(item_text).isNotNull()).toLocalIterator():
        block.append((r[0], r[1].encode()))
        size += len(block[-1][1])
        if size >= block_bytes:
            yield block
            block, size, some = [], 0, True
    if block or not some:
        yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """docs without the rows that meet an item; one Arrow pass over all columns for each block of items, written to the shared folder between two.

    Rows with null and empty texts stay, as do rows with a null key; repeated rows go or stay together; an empty table, or one of items, changes
    nothing; all columns are kept. What meeting an item means is stated above and the same as in contaminated().
    """
    spark = docs.sparkSession
    ship(spark)
    at_text = docs.columns.index(text)

    def passed(rows: DataFrame, block: list) -> DataFrame:
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index([r[0] for r in held.value], [r[1] for r in held.value])
            for batch in batches:
                for b in slices(batch, at_text, 4096):
                    met = {m[0] for m in index.matches([t or b"" for t in b.column(at_text).cast(pa.binary()).to_pylist()])}
                    yield b.filter(pa.array([i not in met for i in range(b.num_rows)], pa.bool_()))

        return rows.mapInArrow(tidy(run), rows.schema)

    kept, first = None, True
    for block in blocks_of(benchmark, item, item_text, block_bytes):
        if not first:  # the documents left by a pass are written before the next one, which keeps one block in a task
            docs, old = keep(docs, "left"), kept
            kept = docs
            if old is not None:
                drop(old)
        docs, first = passed(docs, block), False
    return docs
