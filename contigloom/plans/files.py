"""Round trips: the driver's tables are written as the domain's files and read back; the oracles compute the same from the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contigloom.operators import edges as ed
from contigloom.operators import scaffold, tables, trees
from contigloom.plans import tables as t
from contigloom.runtime import keep, scratch
from contigloom.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return register


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _seq(key: Column, size: Column) -> Column:
    """A made-up sequence: letters of the key's hash, repeated to a size."""
    return F.substring(F.repeat(F.translate(F.md5(_text(key).cast("binary")), "0123456789abcdef", "ACGTACGTACGTACGT"), 40), F.lit(1), size)


def _contigs(spark: SparkSession, sf: str) -> DataFrame:
    p = t.table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("key"), F.col("p_size").cast("int").alias("n"), F.col("p_brand").alias("bin"), _seq(F.col("p_partkey"), F.col("p_size").cast("int") * 20).alias("seq"))


CONTIGS = "contigs AS (SELECT p_partkey AS key, CAST(p_size AS INT) AS n, p_brand AS bin, substr(repeat(translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 40), 1, p_size * 20) AS seq FROM part)"


def _put(spark: SparkSession, lines: DataFrame, name: str, **options) -> str:
    path = scratch(spark, name)
    lines.select("value").write.options(**options).text(path)
    return path


@query(f"WITH {CONTIGS} SELECT 'c' || key AS id, CAST(length(seq) AS INT) AS length, seq, 'c' || key || ' from part' AS descr FROM contigs WHERE length(seq) >= 500")
def fasta_round_trip(spark, sf):
    """Wrapped, compressed records of at least 500 bases."""
    c = _contigs(spark, sf)
    wrapped = F.regexp_replace("seq", "(.{60})", "$1\n")
    path = _put(spark, c.select(F.concat(F.lit(">c"), _text("key"), F.lit(" from part\n"), wrapped).alias("value")), "fasta", compression="gzip")
    return readers.read_fasta(spark, path, 500).select("id", "length", "seq", "descr")


@query(f"WITH {CONTIGS} SELECT CAST(sum(length(seq)) AS BIGINT) AS total, count(*) AS n FROM contigs")
def assembly_size_file(spark, sf):
    path = _put(spark, _contigs(spark, sf).select(F.concat(F.lit(">c"), _text("key"), F.lit("\n"), F.col("seq")).alias("value")), "size")
    return readers.assembly_size(readers.read_fasta(spark, path))


#: Flavour -> header of a contig of n * 20 bases and coverage n + 0.5.
HEADERS = {
    "velvet": "'NODE_' || key || '_length_' || n * 20 || '_cov_' || n || '.5'",
    "soap": "'C' || key || ' length ' || n * 20 || ' cvg_' || n || '.5'",
    "ray": "'contig-' || key || ' ' || n * 20 || ' nucleotides'",
    "soap_contig": "key || '_' || n || '.5'",
    "soap_scaffold": "'scaffold' || key || ' ' || n || '.5'",
    "scaffold": "'scaf' || key || '\t' || 'length: ' || n * 20 || '\t' || 'cov: ' || n || '.5'",
    "plain": "'p' || key",
}


@query("WITH " + CONTIGS + " " + " UNION ALL ".join(f"SELECT '{f}' AS flavour, '{f}' AS sniffed, CAST(key AS VARCHAR) AS key, n * 20 AS length, CAST({1.0 if f in ('ray', 'plain') else 'n + 0.5'} AS DOUBLE) AS coverage FROM contigs" for f in HEADERS))
def contig_headers(spark, sf):
    """Headers of all assemblers: sniffed, and read by their flavour; lengths from headers that have one."""
    out = None
    for flavour, header in HEADERS.items():
        path = _put(spark, _contigs(spark, sf).select(F.concat(F.lit(">"), F.expr(header), F.lit("\n"), F.col("seq")).alias("value")), flavour)
        rows = readers.read_fasta(spark, path, flavour=flavour)
        if flavour in ("velvet", "soap", "ray", "scaffold"):
            rows = readers.header_lengths(rows, flavour=flavour)
        rows = rows.select(F.lit(flavour).alias("flavour"), F.lit(readers.sniff_fasta(spark, path)).alias("sniffed"), F.regexp_extract("id", r"(\d+)", 1).alias("key"), "length", "coverage")
        out = rows if out is None else out.union(rows)
    return out


def _bins(spark: SparkSession, sf: str) -> str:
    path = scratch(spark, "bins")
    c = _contigs(spark, sf).select(F.concat(F.lit("c"), _text("key")).alias("id"), "seq", F.when(F.col("n") > 3, F.regexp_replace("bin", "[^A-Za-z0-9]", "-")).alias("bin"))
    writers.write_fasta_by(c, path, "bin")
    return path


BINS = "CASE WHEN n > 3 THEN regexp_replace(bin, '[^A-Za-z0-9]', '-', 'g') ELSE 'unclustered' END"


@query(f"WITH {CONTIGS} SELECT {BINS} AS bin, 'c' || key AS contig, n * 20 AS length FROM contigs")
def bin_folders(spark, sf):
    """A FASTA folder for each bin, the unbinned ones apart, and which contig is in which."""
    return readers.read_bins(spark, _bins(spark, sf), folders=True)


@query(f"WITH {CONTIGS} SELECT {BINS} AS bin, CAST(count(*) AS BIGINT) AS n_seq, CAST(sum(n * 20) AS BIGINT) AS length FROM contigs GROUP BY 1")
def genome_catalog_folders(spark, sf):
    files = readers.genome_catalog(spark, _bins(spark, sf))
    return files.groupBy(F.regexp_extract("path", "([^/=]+)/[^/]*$", 1).alias("bin")).agg(F.sum("n_seq").alias("n_seq"), F.sum("length").alias("length"))


def _sam(spark: SparkSession, sf: str, lines: bool = False) -> DataFrame:
    li = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").alias("q"), "l_extendedprice")
    name = F.concat(F.lit("r"), _text("l_orderkey"), F.lit("."), _text("l_linenumber"), F.lit("."), _text(F.col("l_extendedprice").cast("bigint")))

    def mate(i: int, contig: str, reverse: Column, mapped: Column) -> Column:
        flag = F.when(reverse, 16).otherwise(0) + F.when(mapped, 0).otherwise(4) + 64 * i
        return F.concat_ws("\t", F.concat(name, F.lit(f"/{i}")), _text(flag), F.when(mapped, F.concat(F.lit("c"), _text(contig))).otherwise("*"), _text(F.col("q") + i), F.lit("60"), F.lit("12M"), F.lit("*"), F.lit("0"), F.lit("0"), F.repeat(F.lit("ACGT"), F.lit(3)), F.repeat(F.lit("I"), F.lit(12)))

    one = mate(1, "l_partkey", F.col("l_returnflag") == "R", F.lit(True))
    two = mate(2, "l_suppkey", F.col("l_linestatus") == "O", F.col("q") % 7 != 0)
    path = _put(spark, writers.with_header(li.select(F.concat_ws("\n", one, two).alias("value")), "@HD\tVN:1.6"), "sam")
    assert readers.sniff_mapping(spark, path) == "sam"
    return readers.read_sam(spark, path, lines)


SAM = "s AS (SELECT 'r' || l_orderkey || '.' || l_linenumber || '.' || CAST(trunc(l_extendedprice) AS BIGINT) AS stem, 'c' || l_partkey AS a, 'c' || l_suppkey AS b, l_returnflag = 'R' AS ra, l_linestatus = 'O' AS rb, CAST(trunc(l_quantity) AS INT) AS q FROM lineitem)"


@query(f"WITH {SAM} SELECT stem || '/1' AS qname, a AS id, q + CASE WHEN ra THEN 11 ELSE 0 END AS pos, false AS strict FROM s UNION ALL SELECT stem || '/1', a, q, true FROM s")
def sam_first_mates(spark, sf):
    """0-based ends of first mates, by the bit of the reverse strand and by the flag's value alone."""
    sam = _sam(spark, sf)
    return readers.sam_hits(sam).withColumn("strict", F.lit(False)).union(readers.sam_hits(sam, strict=True).withColumn("strict", F.lit(True)))


@query(f"WITH {SAM} SELECT stem, CASE WHEN ra THEN '-' ELSE '+' END AS ori1, a AS contig1, q AS pos1, CASE WHEN rb THEN '-' ELSE '+' END AS ori2, b AS contig2, q + 1 AS pos2 FROM s WHERE q % 7 <> 0")
def sam_mates(spark, sf):
    """Mapped rows in the other mapper's columns, and the two mates of a read together."""
    return readers.mate_pairs(readers.sam_to_bowtie(_sam(spark, sf, lines=True))).drop("seq1", "seq2")


@query("""WITH a AS (SELECT l_orderkey AS o, l_partkey AS p, CAST(trunc(l_quantity) AS INT) AS q, l_linenumber AS n, l_returnflag = 'R' AS minus FROM lineitem)
SELECT k.kind, 'r' || o AS rn, 'c' || p AS cn, 0 AS ro, CASE WHEN minus THEN 1 ELSE 0 END AS co, CASE WHEN minus AND k.kind <> 'm1' THEN 990 - n ELSE 10 END AS cs, CASE WHEN minus AND k.kind <> 'm1' THEN 990 + n - n ELSE 10 + n END AS ce,
  1000 AS cl, q AS rs, q + 50 AS re, 200 AS rl, CASE WHEN k.kind = 'paf' THEN q / CAST(n AS DOUBLE) ELSE CAST(q AS DOUBLE) END AS score FROM a, (VALUES ('paf'), ('m1'), ('mhap')) k(kind)""")
def long_alignment_formats(spark, sf):
    """Long-read alignments in three formats, normalised: contig coordinates of reverse ones are flipped."""
    a = t.table(spark, sf, "lineitem").select(F.concat(F.lit("r"), _text("l_orderkey")).alias("rn"), F.concat(F.lit("c"), _text("l_partkey")).alias("cn"), F.col("l_quantity").cast("int").alias("q"), F.col("l_linenumber").alias("n"), (F.col("l_returnflag") == "R").alias("minus"))
    sign, bit, end = F.when(F.col("minus"), "-").otherwise("+"), F.when(F.col("minus"), "1").otherwise("0"), _text(F.col("n") + 10)
    q, q50 = _text("q"), _text(F.col("q") + 50)
    lines = {
        "paf": F.concat_ws("\t", "rn", F.lit("200"), q, q50, sign, "cn", F.lit("1000"), F.lit("10"), end, q, F.lit("60"), F.lit("255")),
        "m1": F.concat_ws(" ", F.concat("rn", F.lit("/0_200")), "cn", F.lit("0"), bit, q, F.lit("99.5"), F.lit("10"), end, F.lit("1000"), q, q50, F.lit("200")),
        "mhap": F.concat_ws(" ", "rn", "cn", F.lit("0.1"), q, F.lit("0"), q, q50, F.lit("200"), bit, F.lit("10"), end, F.lit("1000")),
    }
    out = None
    for kind, line in lines.items():
        rows = readers.read_long_alignments(spark, _put(spark, a.select(line.alias("value")), kind), kind).select(F.lit(kind).alias("kind"), "*")
        out = rows if out is None else out.union(rows)
    return out


@query("""WITH w AS (SELECT l_partkey AS k, l_linenumber AS i, count(*) AS n FROM lineitem GROUP BY 1, 2), g AS (SELECT DISTINCT l_partkey AS k FROM lineitem),
c AS (SELECT g.k, i, coalesce(n, 0) AS n FROM g CROSS JOIN (SELECT unnest(range(1, 8)) AS i) LEFT JOIN w USING (k, i))
SELECT 'c' || k AS id, 2540 AS length, 80 AS left_edge, 2459 AS right_edge, 7 AS num_windows, 0 AS sample, CAST(sum(n) AS INT) AS sum_count, string_agg(n, ' ' ORDER BY i) AS counts FROM c GROUP BY k""")
def windowed_coverage_file(spark, sf):
    """Three-line coverage records, written and read."""
    li = t.table(spark, sf, "lineitem").groupBy("l_partkey").pivot("l_linenumber", list(range(1, 8))).count()
    counts = F.array(*(F.coalesce(F.col(str(i)), F.lit(0)).cast("int") for i in range(1, 8)))
    rows = li.select(F.concat(F.lit("c"), _text("l_partkey")).alias("id"), *(F.lit(v).alias(n) for n, v in (("length", 2540), ("left_edge", 80), ("right_edge", 2459), ("num_windows", 7))), counts.alias("counts"))
    path = scratch(spark, "coverage")
    writers.write_windowed_coverage(rows.withColumn("sum_count", F.aggregate("counts", F.lit(0), lambda s, x: s + x)), path)
    return readers.read_windowed_coverage(spark, path).withColumn("counts", F.array_join(F.transform("counts", lambda x: x.cast("string")), " "))


@query(f"""WITH {t.EDGES}, x AS (SELECT CAST(c1 AS VARCHAR) AS c1, o1, CAST(c2 AS VARCHAR) AS c2, o2, dist, CAST(support % 3 AS INT) AS std, CAST(support AS INT) AS support, c1 % 10 <> 0 AND c2 % 10 <> 0 AS known FROM edges)
SELECT 'plain' AS kind, c1, o1, c2, o2, dist, std, support FROM x UNION ALL SELECT 'scaffold', c1, o1, c2, o2, dist, CASE WHEN std = 0 THEN 1 ELSE std END, support FROM x WHERE known UNION ALL SELECT 'whole', c1, o1, c2, o2, dist, std, support FROM x WHERE support > 1""")
def edge_files(spark, sf):
    """Edge files: as they are, for scaffolding (zero deviations are one, unknown contigs dropped), and with broken lines left out."""
    e = t.edges(spark, sf).select(_text("c1").alias("c1"), "o1", _text("c2").alias("c2"), "o2", "dist", (F.col("support") % 3).cast("int").alias("std"), F.col("support").cast("int").alias("support"))
    path = scratch(spark, "edges")
    writers.write_table(e, path)
    contigs = t.parts(spark, sf).filter(F.col("id") % 10 != 0).select(_text("id").alias("id"))
    line = F.concat_ws("\t", *(F.col(c).cast("string") for c in e.columns))
    broken = _put(spark, e.select(F.when(F.col("support") > 1, line).otherwise(F.concat_ws("\t", "c1", "o1", "c2")).alias("value")), "broken")
    rows = {"plain": readers.read_edges(spark, path, header=True), "scaffold": readers.read_scaffold_edges(spark, path, contigs), "whole": readers.read_edges(spark, broken, whole_rows=True)}
    out = None
    for kind, r in rows.items():
        r = r.select(F.lit(kind).alias("kind"), *e.columns)
        out = r if out is None else out.union(r)
    return out


@query(f"""WITH {t.EDGES}, x AS (SELECT c1, c2, dist * 100 AS d FROM edges)
SELECT CASE WHEN d > -200 AND d < 300 THEN 0 WHEN d >= 300 AND d < 1000 THEN 1 WHEN d >= 1000 AND d < 2000 THEN 2 WHEN d >= 2000 AND d < 5000 THEN 3 WHEN d >= 5000 AND d < 15000 THEN 4 ELSE 5 END AS lib, CAST(count(*) AS BIGINT) AS n, CAST(sum(d) AS BIGINT) AS total
FROM x WHERE d > -200 AND d < 40000 GROUP BY 1""")
def edges_by_distance(spark, sf):
    """Edges in a folder for each stratum of distances."""
    path = scratch(spark, "strata")
    writers.write_edges_by_distance(t.edges(spark, sf).select("c1", "c2", (F.col("dist") * 100).alias("dist")), path)
    return spark.read.schema("c1 long, c2 long, dist int, lib int").option("sep", "\t").csv(path).groupBy("lib").agg(F.count("*").alias("n"), F.sum("dist").alias("total"))


@query("""WITH c AS (SELECT l_orderkey AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos, l_partkey AS p, l_returnflag = 'R' AS minus, CAST(trunc(l_quantity) AS INT) AS q FROM lineitem)
SELECT 'scaf_' || s AS scaffold, CAST(pos AS INT) AS pos, 'c' || p AS contig, CASE WHEN minus THEN '-' ELSE '+' END AS ori, q AS length, q % 5 AS gap FROM c""")
def scaffold_file(spark, sf):
    """Scaffold files: header lines and their children, in order."""
    path = _put(spark, writers.scaffold_lines(_children(spark, sf)), "scaffolds")
    return readers.read_scaffolds(spark, path)


def _children(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    q = F.col("l_quantity").cast("int")
    return t.table(spark, sf, "lineitem").select(F.concat(F.lit("scaf_"), _text("l_orderkey")).alias("scaffold"), pos.alias("pos"), F.concat(F.lit("c"), _text("l_partkey")).alias("contig"), F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("ori"), q.alias("length"), (q % 5).alias("gap"))


@query(f"""WITH {CONTIGS}, c AS (SELECT l_orderkey AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos, l_partkey AS p, l_returnflag = 'R' AS minus, CAST(trunc(l_quantity) AS INT) AS q FROM lineitem),
j AS (SELECT s, pos, CASE WHEN minus THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END || CASE WHEN lead(pos) OVER (PARTITION BY s ORDER BY pos) IS NULL THEN '' ELSE repeat('N', greatest(q % 5 * 4, 10)) END AS piece FROM c JOIN contigs ON key = p)
SELECT 'scaf_' || s AS scaffold, md5(string_agg(piece, '' ORDER BY pos)) AS digest FROM j GROUP BY s""")
def scaffold_sequence_file(spark, sf):
    """Scaffold sequences, gaps as N, written as FASTA and read back."""
    children = _children(spark, sf).withColumn("gap", F.col("gap") * 4)
    seqs = scaffold.scaffold_sequences(children, _contigs(spark, sf).select(F.concat(F.lit("c"), _text("key")).alias("id"), "seq"))
    path = scratch(spark, "scaffold-sequences")
    writers.write_fasta(seqs, path, id="scaffold")
    return readers.read_fasta(spark, path).select(F.col("id").alias("scaffold"), F.md5(F.col("seq").cast("binary")).alias("digest"))


def _fastq(spark: SparkSession, sf: str) -> str:
    c = _contigs(spark, sf).repartition(1).sortWithinPartitions("key")  # one file, whose first reads are asked for
    return _put(spark, c.select(F.concat_ws("\n", F.concat(F.lit("@r"), _text("key"), F.lit(" x")), F.col("seq"), F.lit("+"), F.repeat(F.lit("@"), F.length("seq"))).alias("value")), "fastq")


@query(f"WITH {CONTIGS} SELECT 'r' || key AS name, seq, CAST(length(seq) AS INT) AS length FROM contigs")
def fastq_file(spark, sf):
    path = _fastq(spark, sf)
    assert readers.sniff_reads(spark, path) == "fastq"
    return readers.read_fastq(spark, path).select("name", "seq", "length")


@query(f"WITH {CONTIGS}, f AS (SELECT n FROM contigs ORDER BY key LIMIT 100) SELECT CAST(max(n) * 20 AS INT) AS size FROM f")
def first_reads_size(spark, sf):
    """Largest of the first 100 reads of a file: the limit is the feature."""
    return spark.range(1).select(F.lit(readers.first_reads_size(spark, _fastq(spark, sf), 100)).alias("size"))


@query(f"WITH {CONTIGS} SELECT 'lib' || (key % 3) AS sample, count(*) AS n_reads, CAST(sum(n * 20) AS BIGINT) AS bases, sum(n * 20) / CAST(count(*) AS DOUBLE) AS mean FROM contigs GROUP BY 1")
def library_statistics(spark, sf):
    """Read statistics of a list of libraries; a second call with one more reads only that one."""
    c = _contigs(spark, sf)
    line = F.concat_ws("\n", F.concat(F.lit("@r"), _text("key")), F.col("seq"), F.lit("+"), F.col("seq")).alias("value")
    files = [(f"lib{i}", _put(spark, c.filter(F.col("key") % 3 == i).repartition(1).select(line), "library")) for i in range(3)]
    path = scratch(spark, "statistics")
    tables.read_statistics(spark, files[:2], path)
    return tables.read_statistics(spark, files, path)


@query("SELECT 'r' || s_suppkey || '.fa' AS ref, 'q' || s_nationkey || '.fa' AS query, s_suppkey % 90 / 100.0::DOUBLE AS dist, 0.001::DOUBLE AS p_value, CAST(s_suppkey % 1000 AS INT) AS shared, 1000 AS total FROM supplier")
def sketch_distance_file(spark, sf):
    s = t.table(spark, sf, "supplier")
    line = F.concat_ws("\t", F.concat(F.lit("r"), _text("s_suppkey"), F.lit(".fa")), F.concat(F.lit("q"), _text("s_nationkey"), F.lit(".fa")), _text(F.col("s_suppkey") % 90 / 100), F.lit("0.001"), F.concat(_text(F.col("s_suppkey") % 1000), F.lit("/1000")))
    return readers.read_sketch_distances(spark, _put(spark, s.select(line.alias("value")), "mash"))


@query("SELECT CAST(s_suppkey AS INT) AS s1, CAST(s_suppkey + 99 AS INT) AS e1, 5 AS s2, 104 AS e2, 100 AS len1, 100 AS len2, 98.5::DOUBLE AS idy, 5000 AS len_r, 400 AS len_q, 2.0::DOUBLE AS cov_r, 25.0::DOUBLE AS cov_q, 'ref' || s_nationkey AS name_r, 'c' || s_suppkey AS name_q FROM supplier")
def coords_file(spark, sf):
    """Alignment coordinates below four header lines."""
    s = t.table(spark, sf, "supplier")
    line = F.concat_ws("\t", _text("s_suppkey"), _text(F.col("s_suppkey") + 99), F.lit("5\t104\t100\t100\t98.50\t5000\t400\t2.00\t25.00"), F.concat(F.lit("ref"), _text("s_nationkey")), F.concat(F.lit("c"), _text("s_suppkey")))
    return readers.read_coords(spark, _put(spark, writers.with_header(s.select(line.alias("value")), "a b\nNUCMER\n\n[S1]\t[E1]"), "coords"))


@query("SELECT 'Nation_' || replace(n_name, ' ', '_') AS name, (n_nationkey + 0.5)::DOUBLE AS pct FROM nation WHERE n_regionkey <> 1 AND n_nationkey + 0.5 > 3")
def kraken_report_file(spark, sf):
    """A report's species above a share, names trimmed."""
    n = t.table(spark, sf, "nation")
    line = F.concat_ws("\t", F.concat(F.lit("  "), _text(F.col("n_nationkey") + F.lit(0.5))), F.lit("10\t5"), F.when(F.col("n_regionkey") == 1, "G").otherwise("S"), _text("n_nationkey"), F.concat(F.lit("      Nation "), F.col("n_name"), F.lit(" ")))
    return tables.abundance(readers.read_kraken_report(spark, _put(spark, n.select(line.alias("value")), "report")), "S", 3.0)


@query("SELECT 'c' || s_suppkey AS seq, 'S_' || n_name AS species FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 4 <> 0 AND n_regionkey < 4")
def kraken_output_file(spark, sf):
    """Classified sequences with the species of their taxon, from a dictionary."""
    s = t.table(spark, sf, "supplier")
    line = F.concat_ws("\t", F.when(F.col("s_suppkey") % 4 == 0, "U").otherwise("C"), F.concat(F.lit("c"), _text("s_suppkey")), _text("s_nationkey"), F.lit("900"), F.lit("0:1"))
    names = t.table(spark, sf, "nation").filter("n_regionkey < 4").select(_text("n_nationkey").alias("taxid"), F.concat(F.lit("S_"), F.col("n_name")).alias("species"))
    return readers.read_kraken_output(spark, _put(spark, s.select(line.alias("value")), "kraken"), names)


@query("SELECT 'bin.' || s_suppkey AS bin, (s_suppkey % 100)::DOUBLE AS completeness, (s_suppkey % 13 + 0.25)::DOUBLE AS contamination, CASE WHEN s_suppkey % 100 >= 90 AND s_suppkey % 13 + 0.25 <= 5 THEN 'HIGH' WHEN s_suppkey % 100 >= 50 AND s_suppkey % 13 + 0.25 <= 10 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM supplier")
def bin_evaluation_file(spark, sf):
    """A fixed-width table of bins and their quality tiers."""
    s = t.table(spark, sf, "supplier")
    line = F.concat_ws("     ", F.lit(""), F.concat(F.lit("bin."), _text("s_suppkey")), F.lit("k__Bacteria (UID203)"), _text(F.col("s_suppkey") % 100), _text(F.col("s_suppkey") % 13 + F.lit(0.25)), F.lit("0.00"))
    return tables.quality_tier(readers.read_bin_evaluation(spark, _put(spark, writers.with_header(s.select(line.alias("value")), "-----\n  Bin Id    Marker lineage   Completeness   Contamination   Strain heterogeneity\n-----"), "checkm")))


@query("SELECT 'RS_G' || s_suppkey AS seqid, 'G' || s_suppkey AS genome, 'd__Bacteria;g__' || n_name || ';s__' || n_name || ' ' || s_nationkey AS lineage, replace(n_name, ' ', '_') || '_' || s_nationkey AS species FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def taxonomy_file(spark, sf):
    """A compressed taxonomy: genome ids without their prefix, species names."""
    j = t.table(spark, sf, "supplier").join(t.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    line = F.concat(F.lit("RS_G"), _text("s_suppkey"), F.lit("\td__Bacteria;g__"), F.col("n_name"), F.lit(";s__"), F.col("n_name"), F.lit(" "), _text("s_nationkey"))
    return readers.read_taxonomy(spark, _put(spark, j.select(line.alias("value")), "taxonomy", compression="gzip"))


@query("SELECT 'cl' || s_nationkey AS cluster, string_agg('r' || s_suppkey, ',' ORDER BY s_suppkey) AS refs, min('r' || s_suppkey) FILTER (rn = 1) AS best FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier) GROUP BY s_nationkey")
def ranked_reference_file(spark, sf):
    """Ranked references below the header of their cluster, and the first of each."""
    s = t.table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list("s_suppkey")).alias("x"))
    line = F.concat(F.lit(">cl"), _text("s_nationkey"), F.lit("\n"), F.array_join(F.transform("x", lambda v: F.concat(F.lit("r"), v.cast("string"))), "\n"))
    refs = readers.read_ranked_references(spark, _put(spark, s.select(line.alias("value")), "ranked"))
    return refs.select("cluster", F.array_join("refs", ",").alias("refs"), F.get("refs", F.lit(0)).alias("best"))


@query("""SELECT 'c' || l_partkey AS c1, 'd' || l_suppkey AS c2, 'r' || l_orderkey || '.' || l_linenumber AS read, CAST(l_linenumber AS INT) AS s1, CAST(l_linenumber + 40 AS INT) AS e2, 'x' || l_linenumber || ',y' AS gap FROM lineitem""")
def provenance_file(spark, sf):
    """The reads behind each edge, with coordinates and the contigs between."""
    li = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    n = _text("l_linenumber")
    line = F.concat_ws("\t", F.concat(F.lit("c"), _text("l_partkey")), F.lit("+"), F.concat(F.lit("d"), _text("l_suppkey")), F.lit("-"), F.concat(F.lit("r"), _text("l_orderkey"), F.lit("."), n), F.concat(F.lit("COORD_CONTIG_1:0_"), n, F.lit("_30")), F.concat(F.lit("COORD_CONTIG_2:1_5_"), _text(F.col("l_linenumber") + 40)),
        F.lit("COORD_CONTIG_1_ON_READ:0_1_9"), F.lit("COORD_CONTIG_2_ON_READ:0_11_19"), F.concat(F.lit("CONTIG_FOR_GAPFILLING:x"), n, F.lit(",y,")))
    rows = readers.read_provenance(spark, _put(spark, li.select(line.alias("value")), "provenance")).select("c1", "c2", F.explode("reads").alias("x"))
    return rows.select("c1", "c2", "x.read", F.col("x.c1.s").alias("s1"), F.col("x.c2.e").alias("e2"), F.array_join("x.gap", ",").alias("gap"))


@query("SELECT 'c' || p_partkey AS id, p_size * 100 AS length, CASE WHEN p_partkey % 3 = 0 THEN CAST(trunc(p_retailprice) AS DOUBLE) ELSE 1.0 END AS coverage FROM part")
def coverage_table(spark, sf):
    """A table of coverages below a header, cut to whole numbers, over the coverage that contigs have already."""
    p = t.table(spark, sf, "part").select(F.concat(F.lit("c"), _text("p_partkey")).alias("id"), (F.col("p_size") * 100).alias("length"), "p_retailprice", "p_partkey")
    path = scratch(spark, "coverages")
    writers.write_table(p.filter(F.col("p_partkey") % 3 == 0).select(F.col("id").alias("contig"), "length", F.col("p_retailprice").alias("coverage")), path)
    return readers.with_coverage(p.select("id", "length", F.lit(1.0).alias("coverage")), readers.read_coverage(spark, path))


@query("SELECT 342 AS mean, 21 AS std, 'in' AS ori, count(*) AS n FROM nation")
def library_prose(spark, sf):
    """Figures in the prose of a library file: the first line that gives each."""
    n = t.table(spark, sf, "nation").count()
    text = "Mean length of the library is: 342\nAnother mean: 7\nStandard deviation of the library is: 21\nOrientation of paired-reads is: in\nA later standard deviation is 5"
    path = _put(spark, spark.range(1).select(F.lit(text).alias("value")), "prose")
    return readers.read_library_stats(spark, path).withColumn("n", F.lit(n).cast("long"))


@query("WITH n AS (SELECT n_nationkey AS id, CASE WHEN 2 * n_nationkey + 1 < 25 THEN 2 * n_nationkey + 1 END AS l, CASE WHEN 2 * n_nationkey + 2 < 25 THEN 2 * n_nationkey + 2 END AS r FROM nation) SELECT id FROM n WHERE id NOT IN (SELECT l FROM n WHERE l IS NOT NULL AND id > 0) AND id NOT IN (SELECT r FROM n WHERE r IS NOT NULL AND id > 0)")
def dendrogram_roots(spark, sf):
    """Roots of a stored forest: nodes that are no node's son. The tree's top is cut off, so it has three."""
    k = F.col("n_nationkey")
    son = lambda i: F.when((2 * k + i < 25) & (k > 0), 2 * k + i)
    n = t.table(spark, sf, "nation").select(k.alias("id"), son(1).alias("left"), son(2).alias("right"))
    path = scratch(spark, "tree")
    writers.write_table(n, path)
    rows = spark.read.options(sep="\t", header=True, nullValue="NA").schema("id long, left long, right long").csv(path)
    return trees.tree_roots(rows).select(F.col("id").cast("int").alias("id"))


@query("SELECT p_brand AS brand, p_size AS size, p_partkey AS id, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS tier FROM part")
def tier_folders(spark, sf):
    """A table in folders by tier, read back with the tier of its folder."""
    p = t.table(spark, sf, "part").select(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 25, "big").otherwise("small").alias("tier"))
    path = scratch(spark, "tiers")
    writers.write_table(p, path, partition_by=["tier"])
    return spark.read.options(sep="\t", header=True, nullValue="NA").schema(p.schema).csv(path)


@query(f"""WITH {t.EDGES} SELECT '"' || c1 || '" -- "' || c2 || '" [label="' || o1 || o2 || ' ' || dist || ' (' || support || ')"];' AS value FROM edges""")
def graph_drawing(spark, sf):
    """Edges as lines of a graph description."""
    path = _put(spark, writers.dot_lines(t.edges(spark, sf)), "dot")
    return spark.read.text(path)


@query("SELECT s_nationkey AS nation, count(*) AS n, CAST(2 AS BIGINT) AS runs FROM supplier GROUP BY 1")
def resumed_stages(spark, sf):
    """Stages by the existence of their output: run, resumed without running, and their times appended."""
    folder, n = scratch(spark, "stages"), 0

    def count():
        nonlocal n
        n += 1
        return t.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("n"))

    for _ in range(2):
        run = writers.Stages(spark, folder)
        first = run.run("count", count)
        out = run.run("copy", lambda: first)
    assert n == 1
    return out.withColumn("runs", F.lit(run.timings().count()).cast("long"))


@query(f"""WITH {t.EDGES}, x AS (SELECT e.*, a.s_nationkey AS k1, b.s_nationkey AS k2 FROM edges e JOIN supplier a ON a.s_suppkey = c1 % 10 + 1 JOIN supplier b ON b.s_suppkey = c2 % 10 + 1)
SELECT c1, c2, dist, support, k1 AS cluster1, k2 AS cluster2, least('k' || k1, 'k' || k2) || '-vs-' || greatest('k' || k1, 'k' || k2) AS pair FROM x WHERE k1 <> k2 AND abs(dist) <= 20 AND support >= 2""")
def cross_cluster_edges(spark, sf):
    """Short, well supported edges between different clusters."""
    s = t.table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"))
    clusters = t.parts(spark, sf).select("id").join(s, F.col("id") % 10 + 1 == F.col("s_suppkey")).select(F.col("id").alias("contig"), F.concat(F.lit("k"), _text("k")).alias("cluster"))
    e = ed.cross_cluster_short_edges(keep(t.edges(spark, sf).select("c1", "c2", "dist", "support"), "edges"), clusters, most=20, min_support=2)
    strip = lambda c: F.substring(c, 2, 9).cast("int").alias(c)
    return e.select("c1", "c2", "dist", "support", strip("cluster1"), strip("cluster2"), "pair")
