"""Gap coordinates and sequences from reads, trimming and breaking of sequences, and k-mer links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contigloom.functions.sequence import kmers, reverse_complement, trim_n


def gap_coordinates(reads: DataFrame) -> DataFrame:
    """Gap on the read between two contigs, each extended to its full length: adds start, end and reverse.

    reads: c1, c2 and r1, r2 (structs o, s, e: orientation 0 or 1, start, end on the contig and on the read), len1, len2. The contig that comes first on the read
    is extended to its end, the other one to its start; reverse is set where that is contig 2.
    """
    first = F.col("r1.e") < F.col("r2.e")
    start = F.when(first, F.col("r1.e") + F.col("len1") - F.col("c1.e")).otherwise(F.col("r2.e") + F.col("len2") - F.col("c2.e"))
    end = F.when(first, F.col("r2.s") - F.col("c2.s")).otherwise(F.col("r1.s") - F.col("c1.s"))
    return reads.withColumns({"start": start, "end": end, "reverse": ~first})


def gap_sequences(gaps: DataFrame, reads: DataFrame) -> DataFrame:
    """edge, read, overlap, seq: what a read holds between start and end (0-based, half-open), reverse-complemented where reverse; ends before the start are an overlap and give no sequence.

    gaps: edge, read, start, end, reverse; reads: name, seq. Sequences are never broadcast: their size is not known from their files' or columns'.
    """
    j = gaps.join(reads.select(F.col("name").alias("read"), F.col("seq").alias("_seq")).hint("merge"), "read")
    piece = F.substring("_seq", F.col("start") + 1, F.col("end") - F.col("start"))
    over = F.col("end") < F.col("start")
    return j.select("edge", "read", F.when(over, F.col("start") - F.col("end")).alias("overlap"), F.when(over, "").otherwise(F.when(F.col("reverse"), reverse_complement(piece)).otherwise(piece)).alias("seq"))


def first_read_per_edge(gaps: DataFrame) -> DataFrame:
    """One read for each edge, the first by name."""
    return gaps.withColumn("_n", F.row_number().over(Window.partitionBy("edge").orderBy("read", "start", "end"))).filter("_n = 1").drop("_n")


def valid_tiles(tiles: DataFrame, contig: str = "contig") -> DataFrame:
    """tiles of contigs that are mapped once; contigs mapped again are repeats and invalid everywhere."""
    once = tiles.groupBy(contig).agg(F.count("*").alias("_n")).filter("_n = 1").select(contig)
    return tiles.join(once, contig, "left_semi")


def trim_pattern(seq: Column, pattern: str, max_cut: int) -> Column:
    """Sequence between a pattern (either strand) within max_cut of its start and one within max_cut of its end; null below twice max_cut."""
    table = str.maketrans("ACGT", "TGCA")
    other = pattern.translate(table)[::-1]
    size, n = len(pattern), F.length(seq)
    left = F.least(*(F.when(F.locate(p, seq) > 0, F.locate(p, seq) - 1).otherwise(n) for p in (pattern, other))) + size
    back = F.reverse(seq)
    right = F.greatest(*(F.when(F.locate(p[::-1], back) > 0, n - F.locate(p[::-1], back) + 1 - size).otherwise(0) for p in (pattern, other)))
    low = F.when(left < max_cut, left).otherwise(0)
    high = F.when(right > n - max_cut, right).otherwise(n)
    return F.when(n >= 2 * max_cut, F.substring(seq, low + 1, F.greatest(high - low, F.lit(0))))


def break_at_n(seqs: DataFrame, min_n: int, id: str = "id", seq: str = "seq") -> DataFrame:
    """id, piece, seq: sequences cut at runs of at least min_n N; shorter runs stay inside, leading Ns are not a break."""
    parts = F.split(F.regexp_replace(F.col(seq), "^N+", ""), f"N{{{min_n},}}")
    return seqs.select(id, F.posexplode(F.array_remove(parts, "")).alias("piece", "seq"))


def drop_patterned(contigs: DataFrame, pairs: DataFrame, pattern: str, min_len: int = 0) -> DataFrame:
    """contigs (id, seq) that no read pair with the pattern or its reverse complement hits, Ns trimmed at both ends, of at least min_len; pairs: contig, seq1, seq2."""
    other = reverse_complement(F.lit(pattern))
    has = lambda c: F.contains(F.col(c), F.lit(pattern)) | F.contains(F.col(c), other)
    hit = pairs.filter(has("seq1") | has("seq2")).select(F.col("contig").alias("id"))
    return contigs.join(hit, "id", "left_anti").withColumn("seq", trim_n(F.col("seq"))).filter(F.length("seq") >= min_len)


def end_kmer_links(contigs: DataFrame, k: int) -> DataFrame:
    """a, b: contigs whose last k-mer is another's first."""
    tail = contigs.filter(F.length("seq") >= k).select(F.col("id").alias("a"), F.right("seq", F.lit(k)).alias("kmer"))
    head = contigs.filter(F.length("seq") >= k).select(F.col("id").alias("b"), F.left("seq", F.lit(k)).alias("kmer"))
    return tail.join(head, "kmer").filter("a <> b").select("a", "b", "kmer")


def minimizer_capacity(seqs: DataFrame, k: int = 35, window: int = 5, load: float = 0.7, seq: str = "seq") -> DataFrame:
    """Hash-table capacity for the distinct minimizers of sequences: the estimated number over the load factor, in one row. A minimizer is the k-mer of least hash among window neighbours."""
    hashed = F.transform(kmers(F.col(seq), k), lambda x: F.xxhash64(x))
    least = F.transform(F.sequence(F.lit(1), F.greatest(F.size(hashed) - window + 1, F.lit(1))), lambda i: F.array_min(F.slice(hashed, i, F.lit(window))))
    return seqs.filter(F.length(seq) >= k).select(F.explode(least).alias("m")).agg((F.approx_count_distinct("m") / load).cast("long").alias("capacity"))


def sketch_metrics(distances: DataFrame, cluster: str, reference: str) -> DataFrame:
    """Distance and shared hashes of one (cluster, reference), if known."""
    return distances.filter((F.col("query") == cluster) & (F.col("ref") == reference)).select("dist", "shared", "total").limit(1)


def sketches(seqs: DataFrame, k: int = 21, size: int = 1000, id: str = "id", seq: str = "seq") -> DataFrame:
    """id and h, the size smallest distinct hashes of canonical k-mers; the limit per sequence applies before the shuffle."""
    from contigloom.functions.sequence import canonical
    from contigloom.operators.stats import top_within

    k_rows = seqs.select(id, F.explode(F.array_distinct(kmers(F.upper(seq), k))).alias("kmer")).select(id, F.xxhash64(canonical(F.col("kmer"))).alias("h")).distinct()
    return top_within(k_rows, [id], [F.col("h")], size).drop("rank")


def sketch_distances(queries: DataFrame, references: DataFrame, k: int = 21, size: int = 1000, id: str = "id") -> DataFrame:
    """query, ref, shared, dist from two sketch tables: -1 / k * ln(2 j / (1 + j)), j the share of common hashes of a full sketch. Pairs without one do not appear."""
    a, b = queries.select(F.col(id).alias("query"), "h"), references.select(F.col(id).alias("ref"), "h")
    j = F.col("shared") / float(size)
    return a.join(b, "h").groupBy("query", "ref").agg(F.count("*").alias("shared")).withColumn("dist", F.greatest(-1.0 / k * F.log(2 * j / (1 + j)), F.lit(0.0)))


def names_by_accession(accessions: DataFrame, catalog: DataFrame, key: str = "accession") -> tuple[DataFrame, DataFrame]:
    """(accessions with their catalog row, accessions that the catalog lacks)."""
    return accessions.join(catalog, key), accessions.join(catalog.select(key), key, "left_anti")


def sharded_sketch_distances(queries: DataFrame, references: DataFrame, shards: int, k: int = 21, size: int = 1000, id: str = "id") -> DataFrame:
    """sketch_distances() shard by shard of the references, united; the queries are dealt once by hash and meet every shard. Bounds the join's state
    where references share most of their hashes; the result is that of one join."""
    part = F.pmod(F.xxhash64(id), F.lit(shards))
    out = None
    for i in range(shards):
        found = sketch_distances(queries, references.filter(part == i), k, size, id)
        out = found if out is None else out.unionByName(found)
    return out
