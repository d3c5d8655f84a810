"""Near-duplicate groups by SetSketch registers: band, estimate jointly, verify, connect.

A document's set is its distinct word shingles. Registers are truncated logarithms of exponential minima
(parameters base, rate, limit), so they merge by maximum and equal registers are the likelier, the more alike
two sets are. Documents that share a band of registers are candidates; the likelihood of the larger, equal and
smaller registers, given both set sizes, estimates their Jaccard similarity; the pairs it does not rule out are
counted on their full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.llm.chunks import chunks, hashes, slices, unused
from contigloom.operators.graph import connected_components
from contigloom.runtime import keep, passing, ship, tidy

#: Registers of a sketch.
M = 120
BASE, RATE, LIMIT = 1.001, 20.0, 65534
_rng = np.random.default_rng(20240607)
_MULTIPLIERS = _rng.integers(0, 1 << 31, M, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SEEDS = _rng.integers(0, 1 << 32, M, dtype=np.uint32)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts, whose words are hashed all at once."""

    def __init__(self, width: int):
        self.width = width

    def __call__(self, text: bytes) -> np.ndarray:
        return self.all([text])[0]

    def all(self, texts: list[bytes]) -> list[np.ndarray]:
        """One set for each text. Lower case of bytes changes A-Z only, and words are parted by the six ASCII white-space characters."""
        raw, start, end, first = chunks([t.lower() for t in texts])
        x, width, out = hashes(raw, start, end), self.width, []
        k = max(0, len(x) - width + 1)
        s = x[:k].copy()
        for i in range(1, width):
            s *= _STEP
            s += x[i : i + k]
        s ^= s >> np.uint64(31)
        s *= _MIX
        s ^= s >> np.uint64(29)
        for low, high in zip(first.tolist(), first[1:].tolist()):
            if high - low < width:
                out.append(np.array([xxhash.xxh64_intdigest(b" ".join(raw[start[i] : end[i]] for i in range(low, high)), seed=high - low + 1)] if high > low else [], np.uint64))
                continue
            own = np.sort(s[low : high - width + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), M) uint16 registers; all sets non-empty."""
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    low = np.empty((M, len(sets)), np.uint32)
    r = np.empty_like(x)
    for i in range(M):
        np.bitwise_xor(x, _SEEDS[i], out=r)
        np.multiply(r, _MULTIPLIERS[i], out=r)
        low[i] = np.minimum.reduceat(r, starts)
    u = (low.T.astype(np.float64) + 0.5) / 2.0**32
    k = np.floor(1 - np.log(-np.log1p(-u) / RATE) / math.log(BASE))
    return np.clip(k, 0, LIMIT + 1).astype("<u2")


def band_rows(least: float) -> int:
    """Registers a band: the most for which a pair at the similarity `least` shares no band with a probability below one in a million."""
    return max((r for r in range(1, M + 1) if M % r == 0 and (1 - least**r) ** (M // r) < 1e-6), default=1)


_GRID = np.linspace(0, 1, 101)


def joint_estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity (in hundredths) of row pairs of registers, the set sizes being known."""
    up, down = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - up - down
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    tiny = 1e-12

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    more, less = p(u - v * _GRID), p(v - u * _GRID)
    likelihood = up * np.log(more + tiny) + down * np.log(less + tiny) + same * np.log(np.maximum(1 - more - less, tiny))
    likelihood[np.minimum(u / v, v / u) + 0.005 < _GRID] = -np.inf
    return _GRID[likelihood.argmax(1)]


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """key, n_shingles, set_hash (of the whole set), sketch (registers, null without words) and copy (a hash of the text) of every row."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(width)
        for batch in batches:
            for b in slices(batch, 1, 128):
                sets = shingles.all(b.column(1).cast(pa.binary()).to_pylist())
                full = [s for s in sets if len(s)]
                rows = iter(registers(full)) if full else iter(())
                size, digest = pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary())
                sketches = pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), size, digest, sketches, b.column(2)], names=[key, "n_shingles", "set_hash", "sketch", "copy"])

    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key), whole.alias(text), F.xxhash64(whole).alias("copy")).mapInArrow(tidy(run), f"`{key}` {kind}, n_shingles long, set_hash binary, sketch binary, copy long")


def _both(a: np.ndarray, b: np.ndarray) -> int:
    """Number of values in both of two sorted sets."""
    at = np.searchsorted(a, b)
    return int((a[np.minimum(at, len(a) - 1)] == b).sum()) if len(a) else 0


def _slack(least: float) -> float:
    """How far below the similarity an estimate from registers may lie: five standard errors."""
    return 5 * math.sqrt(least * (1 - least) / M)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) of runs of equal values in the first columns of sorted rows; equal rows of a run that follow one another count once."""
    last, held = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                if row[:keys] != last:
                    if held:
                        yield last, held
                    last, held = row[:keys], []
                if not held or row[keys:] != held[-1]:
                    held.append(row[keys:])
    if held:
        yield last, held


class Family:
    """Documents that may be similar to one another, some of them connected already: finds links enough to connect all that are linked."""

    def __init__(self, rows: list[tuple], cross: bool):
        """rows: block, key, copy, component known so far, text. cross: only pairs of different blocks are looked at."""
        self.blocks, self.keys, self.cross = np.array([r[0] for r in rows]), [r[1] for r in rows], cross
        names = {c: i for i, c in enumerate({r[3] for r in rows})}
        self.component, self.texts = np.array([names[r[3]] for r in rows]), [r[4] for r in rows]

    def links(self, sets: list[np.ndarray], regs: np.ndarray, least: float) -> list[tuple[int, int]]:
        """Pairs of places. A pair is verified on its full sets if it shares a band, its sizes and registers allow the similarity, and its
        documents are not connected yet; the likeliest pairs first."""
        n, percent, slack = len(sets), round(least * 100), _slack(least)
        size = np.array([len(s) for s in sets])
        per = band_rows(least)
        parts = regs.reshape(n, M // per, per).astype(np.uint64)
        bands = np.zeros((n, M // per), np.uint64)
        for i in range(per):
            bands = bands * _STEP + parts[:, :, i]
        component, found = self.component, []
        for x in range(n - 1):
            y = np.arange(x + 1, n)
            ok = (component[y] != component[x]) & (100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x]))
            if self.cross:
                ok &= self.blocks[y] != self.blocks[x]
            y = y[ok]
            y = y[(bands[y] == bands[x]).any(1)]
            if not len(y):
                continue
            j = joint_estimate(np.broadcast_to(regs[x], (len(y), M)), regs[y], np.full(len(y), float(size[x])), size[y].astype(float))
            for k in np.argsort(-j, kind="stable").tolist():
                other = int(y[k])
                if j[k] < least - slack:
                    break
                if component[other] == component[x]:
                    continue
                both = _both(sets[x], sets[other])
                if 100 * both >= percent * (size[x] + size[other] - both):
                    found.append((x, other))
                    component[component == component[other]] = component[x]
        return found


def links_of(rows: DataFrame, width: int, least: float) -> DataFrame:
    """Links (a, b) inside blocks of families: rows (family, i, j, block, rep, copy, known, text) hold, for every pair of blocks of a family, the documents of both.

    The rows of one pair of blocks, a bounded number, are next to one another in a task, and the links of a task connect what is linked in it.
    """

    def solve(ready: list[Family], shingles: Shingler) -> pa.RecordBatch:
        sets = [shingles.all(f.texts) for f in ready]
        regs = registers([s for own in sets for s in own])
        a, b, at = [], [], 0
        for f, own in zip(ready, sets):
            for x, y in f.links(own, regs[at : at + len(own)], least):
                a.append(f.keys[x])
                b.append(f.keys[y])
            at += len(own)
        return pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, ready, held = Shingler(width), [], 0
        for (_, i, j), own in _runs(batches, 3):
            if len(own) > 1:
                ready.append(Family(own, i != j))
                held += len(own)
            if held >= 64:
                yield solve(ready, shingles)
                ready, held = [], 0
        if ready:
            yield solve(ready, shingles)

    spark_kind, kind = _kinds(rows)
    columns = ["family", "i", "j", "block", "rep", "copy", "known"]
    ordered = rows.select(*columns, F.col("text").cast("binary").alias("text")).repartition("family", "i", "j").sortWithinPartitions(*columns)
    return ordered.mapInArrow(tidy(run), f"a {spark_kind}, b {spark_kind}")


def _kinds(rows: DataFrame) -> tuple[str, pa.DataType]:
    """Spark's and Arrow's type of the keys."""
    return rows.schema["rep"].dataType.simpleString(), rows.limit(0).select("rep").toArrow().schema.field(0).type


def _in_blocks(member: DataFrame, by: str, rows: int, *salt: str, text_bytes: int | None = None) -> DataFrame:
    """member with blocks (how many its group by a column has, of about so many rows and bytes of text) and block (by a hash)."""
    parts = [F.ceil(F.count("*") / rows), F.ceil(F.sum(F.octet_length("text")) / text_bytes)] if text_bytes else [F.ceil(F.count("*") / rows)] * 2
    size = member.groupBy(by).agg(F.greatest(*parts).cast("int").alias("blocks"))
    return member.join(size, by).withColumn("block", F.pmod(F.xxhash64("rep", "copy", *salt), F.col("blocks")).cast("int"))


def _block_pairs(rows: DataFrame) -> DataFrame:
    """A copy of each row for every pair of blocks, i up to j, that its own is in."""
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def spanning(regs: np.ndarray, size: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs of places that span each bucket's documents by most equal registers (Prim), of those that may be as similar as `least`."""
    n, percent = len(regs), round(least * 100)
    same, parent, left = np.full(n, -1), np.full(n, -1), np.ones(n, bool)
    pairs, x = [], 0
    for _ in range(n - 1):
        left[x] = False
        equal = (regs == regs[x]).sum(1)
        nearer = left & (equal > same) & (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x]))
        same[nearer], parent[nearer] = equal[nearer], x
        x = int(np.where(left, same, -2).argmax())
        if parent[x] >= 0:
            pairs.append((int(parent[x]), x))
    if not pairs:
        return []
    a, b = np.array(pairs).T
    fine = joint_estimate(regs[a], regs[b], size[a].astype(float), size[b].astype(float)) >= least - _slack(least)
    return [p for p, f in zip(pairs, fine) if f]


def likely_pairs(rows: DataFrame, least: float) -> DataFrame:
    """Pairs (a, a_copy, b, b_copy) that span the likely links of each (bucket, block): rows bucket, block, rep, copy, n_shingles, sketch."""
    spark_kind, kind = _kinds(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in _runs(batches, 2):
            regs = np.frombuffer(b"".join(r[3] for r in own), "<u2").reshape(len(own), M)
            found = spanning(regs, np.array([r[2] for r in own]), least)
            ends = [sorted((own[x][:2], own[y][:2])) for x, y in found]
            yield pa.RecordBatch.from_arrays([pa.array([e[k][c] for e in ends], (kind, pa.int64())[c]) for k in (0, 1) for c in (0, 1)], names=["a", "a_copy", "b", "b_copy"])

    columns = ["bucket", "block", "rep", "copy", "n_shingles", "sketch"]
    ordered = rows.select(columns).repartition("bucket", "block").sortWithinPartitions("bucket", "block", "rep", "copy")
    return ordered.mapInArrow(tidy(run), f"a {spark_kind}, a_copy long, b {spark_kind}, b_copy long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """Those pairs (a, b) that are links, by their full sets. Each pair fetches its two texts."""
    spark_kind, percent = _kinds(texts)[0], round(least * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(width)
        for batch in batches:
            for b in slices(batch, 2, 128):
                left, right = (shingles.all(b.column(k).to_pylist()) for k in (2, 3))
                both = [_both(x, y) for x, y in zip(left, right)]
                yield b.filter(pa.array([100 * n >= percent * (len(x) + len(y) - n) for n, x, y in zip(both, left, right)], pa.bool_())).select([0, 1])

    for end in ("a", "b"):
        one = texts.select(F.col("rep").alias(end), F.col("copy").alias(f"{end}_copy"), F.col("text").cast("binary").alias(f"text_{end}"))
        pairs = pairs.join(one.hint("merge"), [end, f"{end}_copy"])
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(tidy(run), f"a {spark_kind}, b {spark_kind}")


def open_pairs(rows: DataFrame, least: float) -> DataFrame:
    """Ties (a, b) between documents of a bucket that may be linked and are not connected yet, enough to connect all such: rows bucket, i, j, block,
    rep, copy, known, n_shingles, sketch."""
    spark_kind, kind = _kinds(rows)
    percent, slack = round(least * 100), _slack(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), own in _runs(batches, 3):
            names = {c: k for k, c in enumerate({r[3] for r in own})}
            block, known, size = (np.array(x) for x in zip(*((r[0], names[r[3]], r[4]) for r in own)))
            regs = np.frombuffer(b"".join(r[5] for r in own), "<u2").reshape(len(own), M)
            tied, a, b = np.arange(len(own)), [], []
            for x in range(len(own) - 1):
                y = np.arange(x + 1, len(own))
                y = y[(known[y] != known[x]) & (tied[y] != tied[x]) & (100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x])) & ((i == j) | (block[y] != block[x]))]
                if len(y):
                    est = joint_estimate(np.broadcast_to(regs[x], (len(y), M)), regs[y], np.full(len(y), float(size[x])), size[y].astype(float))
                    for k in y[est >= least - slack].tolist():
                        if tied[k] != tied[x]:
                            a.append(own[x][1])
                            b.append(own[k][1])
                            tied[tied == tied[k]] = tied[x]
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], names=["a", "b"])

    columns = ["bucket", "i", "j", "block", "rep", "copy", "known", "n_shingles", "sketch"]
    ordered = rows.select(columns).repartition("bucket", "i", "j").sortWithinPartitions(*columns[:6])
    return ordered.mapInArrow(tidy(run), f"a {spark_kind}, b {spark_kind}")


def _buckets(nodes: DataFrame, least: float) -> DataFrame:
    """A row for each node and band, named by the band's bucket."""
    per = band_rows(least)
    return nodes.withColumn("bucket", F.explode(F.array(*(F.xxhash64(F.lit(i), F.substring("sketch", 1 + 2 * per * i, 2 * per)) for i in range(M // per)))))


def large_family_links(member: DataFrame, texts: DataFrame, width: int, least: float, block_rows: int, block_shingles: int) -> tuple[DataFrame, DataFrame]:
    """(links found, rows for links_of) of families of many blocks, by way of their buckets, so that texts are not copied for every pair of blocks.

    First, the pairs that span each bucket by most equal registers are verified, each on its own two texts; this connects groups of near copies
    with a number of pairs in proportion to the documents. Then only documents that may still be linked to one of another component make families
    again, by their sketches; these go to the exact way over pairs of blocks, where what is connected is not compared again. Hot buckets are cut into
    blocks by a hash that differs from band to band, and into pairs of blocks where components have stayed apart.
    """
    rows = keep(_buckets(member.select("rep", "copy", "n_shingles", "sketch"), least), "buckets")
    some = keep(rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"), "shared")
    shared = rows.join(some, "bucket")
    pairs = keep(likely_pairs(_in_blocks(shared, "bucket", 2 * block_rows, "bucket"), least), "pairs")
    links = keep(verified(pairs, texts, width, least), "links")
    known = connected_components(links).select(F.col("vertex").alias("rep"), F.col("component").alias("known"))
    named = keep(shared.join(known, "rep", "left").withColumn("known", F.coalesce("known", "rep")), "known")
    apart = named.groupBy("bucket").agg(F.min("known").alias("lo"), F.max("known").alias("hi")).filter("lo < hi").select("bucket")
    ties = keep(open_pairs(_block_pairs(_in_blocks(named.join(apart, "bucket"), "bucket", 2 * block_rows)), least), "ties")
    family = connected_components(ties).select(F.col("vertex").alias("rep"), F.col("component").alias("family"))
    again = texts.join(family, "rep").join(known, "rep", "left").withColumn("known", F.coalesce("known", "rep"))
    return links, _block_pairs(_in_blocks(again, "family", block_rows, text_bytes=6 * block_shingles))


def classes(docs: DataFrame, key: str, text: str, width: int = 5, least: float = 0.85, block_rows: int = 512, block_shingles: int = 2_000_000) -> DataFrame:
    """doc (the key), copy (a hash of the text), n_shingles and component (smallest key reachable over links) of every row.

    Links join sets with intersection >= least * union (in whole hundredths). Equal sets are one node from the start, so copies cost no pairs. Nodes that share
    a band's bucket are tied to the bucket's smallest node, and what is tied together is a family. A family of one block (block_rows documents) is solved
    by itself in one task; larger ones go by way of their buckets, see large_family_links(). No link between different sets that share a bucket is lost, no
    task holds more than two blocks, and no pairs are written but a number in proportion to the documents. A pair at the limit shares no band with a
    probability below one in a million.
    Null or word-less texts: 0 shingles, linked with nothing. Null keys: never a component's name; a group of only null keys
    has component null and is not kept. Rows that share a key each have the component of their own text's set; sets named by one key are one node.
    Extra columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sk = keep(sketch(docs, "doc", "text", width), "sketches")
    first = F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "copy")))
    nodes = sk.filter("n_shingles > 0").groupBy("set_hash").agg(first.alias("first"), F.min("n_shingles").alias("n_shingles"), F.min("sketch").alias("sketch"))
    nodes = keep(nodes.select("set_hash", F.col("first.doc").alias("rep"), F.col("first.copy").alias("copy"), "n_shingles", "sketch"), "nodes")
    rows = _buckets(nodes.filter("rep is not null"), least).select("rep", "bucket")
    shared = rows.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("bucket", "lo")
    ties = rows.join(shared, (rows["bucket"] == shared["bucket"]) & (F.col("rep") != F.col("lo"))).select(F.col("lo").alias("a"), F.col("rep").alias("b"))
    family = connected_components(ties).select(F.col("vertex").alias("rep"), F.col("component").alias("family"))
    size = family.join(nodes.select("rep", "n_shingles"), "rep").groupBy("family").agg(F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum("n_shingles") / block_shingles)).cast("int").alias("blocks"))
    member = keep(family.join(size, "family").join(nodes, "rep"), "families")
    large = member.filter("blocks > 1").limit(1).count() > 0
    # a merge join at every size: the members grow with the corpus
    named = member.select(F.col("rep").alias("doc"), "copy", "family", "blocks")
    texts = docs.withColumn("copy", F.xxhash64("text")).hint("merge").join(named, ["doc", "copy"]).withColumnRenamed("doc", "rep").withColumn("known", F.col("rep"))
    if large:
        texts = keep(texts, "texts")
    zero = F.lit(0)
    links = keep(links_of(texts.filter("blocks = 1").select("family", zero.alias("i"), zero.alias("j"), zero.alias("block"), "rep", "copy", "known", "text"), width, least), "links")
    if large:
        one = texts.filter("blocks > 1").select("rep", "copy", "text").dropDuplicates(["rep", "copy"])
        more, rest = large_family_links(member.filter("blocks > 1"), one, width, least, block_rows, block_shingles)
        links = links.union(more).union(links_of(rest, width, least))
    labels = connected_components(links)
    names = nodes.select("set_hash", "rep").join(labels.withColumnRenamed("vertex", "rep"), "rep", "left").select("set_hash", F.coalesce("component", "rep").alias("component"))
    out = sk.select("doc", "copy", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_hash")).alias("set_hash")).join(names, "set_hash", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc"))
    return out.select("doc", "copy", "n_shingles", own.alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, least: float = 0.85, block_rows: int = 512, block_shingles: int = 2_000_000) -> DataFrame:
    """key, n_shingles, component_id (smallest key reachable over links) and kept (is that key) of every row; see classes()."""
    own = F.col("component")
    out = classes(docs, key, text, width, least, block_rows, block_shingles)
    return out.select(F.col("doc").alias(key), "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc") == own, F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", broadcast_bytes: int = 32 << 20, least: float = 0.85) -> DataFrame:
    """docs with one document of each near-duplicate group (links from a similarity of `least`), the one that names it.

    The rows to leave out, named by key and text hash, are broadcast only if they are few, else anti-joined by a shuffle. Of rows that share a key, one stays,
    of the text that is kept; rows without a key are left out.
    """
    lasting: list[DataFrame] = []
    with passing(lasting):
        found = classes(docs, key, text, least=least).filter(F.col("doc").isNotNull())
        found = keep(found.groupBy("doc", "copy").agg(F.max(F.coalesce(F.col("doc") == F.col("component"), F.lit(False))).alias("kept"), F.count("*").alias("n")), "kept")
        lasting.append(found)
    seen = found.groupBy("doc").agg(F.count_if(~F.col("kept")).alias("drop"), F.sum("n").alias("n"))
    n = seen.agg(F.coalesce(F.sum("drop"), F.lit(0)).alias("drop"), F.count_if((F.col("n") > 1) & (F.col("n") > F.col("drop"))).alias("repeated")).first()
    mark = unused(docs.columns, "_gone")
    gone = found.filter(~F.col("kept")).select(F.col("doc").alias(f"{mark}_doc"), F.col("copy").alias(f"{mark}_copy"))
    rows = docs.filter(F.col(key).isNotNull())
    same = (F.col(key) == F.col(f"{mark}_doc")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col(f"{mark}_copy"))
    out = rows.join(F.broadcast(gone) if n["drop"] * 64 <= broadcast_bytes else gone.hint("merge"), same, "left_anti")
    return (out.dropDuplicates([key]) if n["repeated"] else out).select(docs.columns)


#: Components of links from 0.85 by a join of all shingles.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents),
h AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) >= 5 THEN list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' ')) WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM h GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM h a JOIN h b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN c ON c.x = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""
