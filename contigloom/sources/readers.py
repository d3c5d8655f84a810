"""Readers of sequence, alignment, edge, coverage and annotation files. Compressed files are read by their suffix."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contigloom.operators.coverage import geometry_columns


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (0-based) and value of every line.

    The number is the place within a (task, file) plus the lines of that file in earlier tasks; only those totals, one row per task and file, pass a window.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_id"), "value").withColumn("_part", F.shiftright("_id", 33))
    parts = raw.groupBy("file", "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("file", "_part", "_first", before.alias("_before"))
    return raw.join(F.broadcast(parts), ["file", "_part"]).select("file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("line"), "value")


#: Lines that one window of filled() holds.
FILL_LINES = 20_000


def filled(lines: DataFrame, name: Column) -> DataFrame:
    """numbered_lines() with header: the last value of name (null on other lines) at or above a line.

    Blocks of FILL_LINES lines are filled by themselves; what a block begins with comes from a window over one row for each block of a file.
    """
    rows = lines.withColumn("_block", F.floor(F.col("line") / FILL_LINES)).withColumn("_name", name)
    last = rows.groupBy("file", "_block").agg(F.max_by("_name", F.when(F.col("_name").isNotNull(), F.col("line"))).alias("_last"))
    above = F.last("_last", ignorenulls=True).over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    inside = F.last("_name", ignorenulls=True).over(Window.partitionBy("file", "_block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.join(last.select("file", "_block", above.alias("_above")), ["file", "_block"]).withColumn("header", F.coalesce(inside, "_above"))
    return rows.drop("_block", "_name", "_above")


#: How each assembler's header gives coverage: flavour -> column of the header text.
FLAVOURS = {
    "plain": lambda h: F.lit(1.0),
    "soap": lambda h: F.regexp_extract(h, r"cvg_([0-9.]+)", 1).cast("double"),
    "soap_scaffold": lambda h: F.get(F.split(h, r"\s+"), F.lit(1)).try_cast("double"),
    "soap_contig": lambda h: F.get(F.split(h, "_"), F.lit(1)).try_cast("double"),
    "velvet": lambda h: F.substring_index(F.substring_index(h, " ", 1), "_", -1).try_cast("double"),
    "scaffold": lambda h: F.regexp_extract(h, r"cov: ([0-9.]+)", 1).try_cast("double"),
    "ray": lambda h: F.lit(1.0),
}


def read_fasta(spark: SparkSession, path: str, min_len: int = 0, flavour: str = "plain") -> DataFrame:
    """id (header up to the first space), descr, seq (lines joined), length, coverage (from the header, by flavour), file; at least min_len long.

    Records are split at '>' after a line end by the text source itself, so large files stay splittable.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("v"), F.col("_metadata.file_path").alias("file")).filter("trim(v) <> ''")
    head = F.regexp_replace(F.substring_index("v", "\n", 1), "\r$", "")
    seq = F.when(F.contains("v", F.lit("\n")), F.regexp_replace(F.expr("substring(v, instr(v, '\n') + 1)"), r"\s", "")).otherwise("")
    out = raw.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), head.alias("descr"), seq.alias("seq"), "file")
    out = out.withColumns({"length": F.length("seq"), "coverage": F.coalesce(FLAVOURS[flavour](F.col("descr")), F.lit(1.0))})
    return out.filter(F.col("length") >= min_len) if min_len else out


def header_lengths(headers: DataFrame, header: str = "descr", flavour: str = "velvet") -> DataFrame:
    """headers with the length that an assembler wrote into them."""
    pattern = {"velvet": r"length_(\d+)", "soap": r"length (\d+)", "ray": r"(\d+) nucleotides", "scaffold": r"length: (\d+)"}[flavour]
    return headers.withColumn("length", F.regexp_extract(header, pattern, 1).try_cast("int"))


def sniff_fasta(spark: SparkSession, path: str) -> str:
    """Flavour of a contig file, from its first line."""
    head = (spark.read.text(path).limit(1).collect() or [[""]])[0][0]
    for name, pattern in (("scaffold", r"length: \d+.*cov: "), ("velvet", r"^>NODE_\d+_length_"), ("soap", r"^>\S+ length \d+ cvg_"), ("soap_contig", r"^>[^_\s]+_[0-9.]+"), ("ray", r"^>\S+ \d+ nucleotides"), ("soap_scaffold", r"^>\S+\s+[0-9.]+\s*$")):
        if re.search(pattern, head):
            return name
    return "plain"


def sniff_reads(spark: SparkSession, path: str) -> str:
    """fasta or fastq, from the first character."""
    head = (spark.read.text(path).limit(1).collect() or [[""]])[0][0]
    return "fastq" if head.startswith("@") else "fasta"


def sniff_mapping(spark: SparkSession, path: str) -> str:
    """sam or bowtie, from the first line."""
    head = (spark.read.text(path).limit(1).collect() or [[""]])[0][0]
    fields = head.split("\t")
    return "sam" if head.startswith("@") or (len(fields) > 10 and fields[1].isdigit()) else "bowtie"


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """name, seq, qual, length of every four-line record; the last one counts too."""
    lines = numbered_lines(spark, path).withColumns({"rec": F.floor(F.col("line") / 4), "k": F.col("line") % 4})
    rows = lines.groupBy("file", "rec").agg(*(F.max(F.when(F.col("k") == k, F.col("value"))).alias(n) for k, n in ((0, "name"), (1, "seq"), (3, "qual"))))
    return rows.filter("name is not null and seq is not null").select(F.regexp_extract("name", r"^@?(\S*)", 1).alias("name"), "seq", "qual", F.length("seq").alias("length"))


SAM_COLUMNS = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
_SAM_INTS = ("flag", "pos", "mapq", "pnext", "tlen")


def read_sam(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The eleven columns of a SAM file (pos 1-based). With lines, file and line (0-based) of each too."""
    t = (numbered_lines(spark, path) if lines else spark.read.text(path)).filter(~F.col("value").rlike(r"^@[A-Z]{2}(\t|$)") & F.contains("value", F.lit("\t")))
    f = F.split("value", "\t")
    return t.select(*((F.get(f, F.lit(i)).try_cast("int") if n in _SAM_INTS else F.get(f, F.lit(i))).alias(n) for i, n in enumerate(SAM_COLUMNS)), *(("file", "line") if lines else ()))


def sam_hits(sam: DataFrame, strict: bool = False) -> DataFrame:
    """qname, id and pos (0-based) of first mates: the rightmost base of reverse alignments. strict takes flag 16 alone as reverse, else its bit."""
    reverse = F.col("flag") == 16 if strict else F.col("flag").bitwiseAND(16) != 0
    pos = F.col("pos") - 1 + F.when(reverse, F.length("seq") - 1).otherwise(0)
    return sam.filter(~F.endswith("qname", F.lit("2")) & (F.col("rname") != "*")).select("qname", F.col("rname").alias("id"), pos.alias("pos"))


def sam_to_bowtie(sam: DataFrame) -> DataFrame:
    """read, ori, contig, pos (0-based), seq of mapped rows, and their file and line if sam has them."""
    return sam.filter(F.col("flag").bitwiseAND(4) == 0).select(F.col("qname").alias("read"), F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+").alias("ori"), F.col("rname").alias("contig"), (F.col("pos") - 1).alias("pos"), "seq", *(c for c in ("file", "line") if c in sam.columns))


MATE_COLUMNS = ("ori", "contig", "pos", "seq")


def mate_pairs(aln: DataFrame) -> DataFrame:
    """Both mates of a read, by its name without the last two characters: stem and the columns of mate 1 and 2.

    Reads that share a name are told apart if aln has file and line: mates on neighbouring lines are one read's. Of an odd number of such lines in a row, that begin with
    a mate 2, the first one is left over, else the last. Mates that are left over go by the name alone, like all those without lines.
    """
    rows = aln.withColumns({"stem": F.expr("substring(read, 1, length(read) - 2)"), "_mate": F.expr("right(read, 1)")}).filter(F.col("_mate").isin("1", "2"))

    def side(df: DataFrame, i: int) -> DataFrame:
        return df.filter(F.col("_mate") == str(i)).select("stem", *(F.col(c).alias(f"{c}{i}") for c in MATE_COLUMNS))

    if not {"file", "line"} <= set(aln.columns):
        return side(rows, 1).join(side(rows, 2), "stem")
    name = Window.partitionBy("stem").orderBy("file", "line")
    follows = (F.lag("file").over(name) == F.col("file")) & (F.lag("line").over(name) == F.col("line") - 1) & (F.lag("_mate").over(name) != F.col("_mate"))
    rows = rows.withColumn("_new", F.when(follows, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(name.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("stem", "_run").orderBy("line")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"_n": F.count("*").over(whole), "_k": F.row_number().over(run), "_next": F.lead(F.struct(*MATE_COLUMNS)).over(run)})
    odd = F.col("_n") % 2 == 1
    late = odd & (F.col("_mate") == F.when(F.col("_k") % 2 == 1, "2").otherwise("1"))  # begins with a mate 2
    rows = rows.withColumns({"_alone": odd & (F.col("_k") == F.when(late, 1).otherwise(F.col("_n"))), "_first": F.col("_k") % 2 == F.when(late, 0).otherwise(1)})
    others = F.collect_list(F.when(F.col("_alone") & (F.col("_mate") == "2"), F.struct(*MATE_COLUMNS))).over(Window.partitionBy("stem"))
    rows = rows.withColumn("_others", others)
    rows = rows.withColumn("_other", F.explode(F.when(F.col("_alone"), F.when(F.col("_mate") == "1", F.col("_others"))).when(F.col("_first"), F.array("_next"))))
    of = lambda c, i: F.when(F.col("_mate") == str(i), F.col(c)).otherwise(F.col(f"_other.{c}")).alias(f"{c}{i}")
    return rows.select("stem", *(of(c, i) for i in (1, 2) for c in MATE_COLUMNS))


def read_long_alignments(spark: SparkSession, path: str, kind: str = "paf") -> DataFrame:
    """Normalised long-read alignments: rn, cn, ro, co, cs, ce, cl, rs, re, rl, score; contig coordinates of reverse alignments are flipped.

    kinds: paf (matches over span as score), m1 (blasr), mhap (graphmap). Coordinates are 0-based, half-open.
    """
    f = F.split(F.trim("value"), "\t" if kind == "paf" else r"\s+")
    at = lambda i, t="int": F.get(f, F.lit(i)).try_cast(t)
    if kind == "paf":
        minus = at(4, "string") == "-"
        cs, ce, cl = at(7), at(8), at(6)
        cols = {"rn": at(0, "string"), "cn": at(5, "string"), "ro": F.lit(0), "co": minus.cast("int"), "cs": F.when(minus, cl - ce).otherwise(cs), "ce": F.when(minus, cl - cs).otherwise(ce), "cl": cl, "rs": at(2), "re": at(3), "rl": at(1), "score": F.try_divide(at(9).cast("double"), ce - cs)}
    elif kind == "m1":
        cols = {"rn": F.regexp_replace(at(0, "string"), "/[^/]*$", ""), "cn": at(1, "string"), "ro": at(2), "co": at(3), "cs": at(6), "ce": at(7), "cl": at(8), "rs": at(9), "re": at(10), "rl": at(11), "score": at(4, "double")}
    elif kind == "mhap":
        minus = at(8) == 1
        cs, ce, cl = at(9), at(10), at(11)
        cols = {"rn": at(0, "string"), "cn": at(1, "string"), "ro": at(4), "co": at(8), "cs": F.when(minus, cl - ce).otherwise(cs), "ce": F.when(minus, cl - cs).otherwise(ce), "cl": cl, "rs": at(5), "re": at(6), "rl": at(7), "score": at(3, "double")}
    else:
        raise ValueError(kind)
    return spark.read.text(path).filter("trim(value) <> ''").select(*(c.alias(n) for n, c in cols.items()))


EDGE_SCHEMA = "c1 string, o1 string, c2 string, o2 string, dist int, std int, support int"


def _tsv(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    return spark.read.options(**({"sep": "\t", "nullValue": "NA", "quote": ""} | options)).schema(schema).csv(path)


def read_edges(spark: SparkSession, path: str, header: bool = False, whole_rows: bool = False) -> DataFrame:
    """Edge rows; whole_rows drops lines without exactly seven columns."""
    return _tsv(spark, path, EDGE_SCHEMA, header=header, mode="DROPMALFORMED" if whole_rows else "PERMISSIVE")


def read_scaffold_edges(spark: SparkSession, path: str, contigs: DataFrame, id: str = "id") -> DataFrame:
    """Edges for scaffolding: a header line, deviations of 0 as 1, edges of unknown contigs dropped."""
    e = read_edges(spark, path, header=True).withColumn("std", F.when(F.col("std") == 0, 1).otherwise(F.col("std")))
    return e.join(contigs.select(F.col(id).alias("c1")), "c1", "left_semi").join(contigs.select(F.col(id).alias("c2")), "c2", "left_semi")


def read_provenance(spark: SparkSession, path: str) -> DataFrame:
    """Edges with their reads as an array of structs: read, c1, c2, r1, r2 (o, s, e each) and gap contigs."""
    f = F.split("value", "\t")
    lists = lambda i, tag: F.split(F.regexp_replace(F.get(f, F.lit(i)), f"^{tag}:", ""), ";")
    place = lambda text: F.transform(text, lambda x: F.struct(F.get(F.split(x, "_"), F.lit(0)).alias("o"), F.get(F.split(x, "_"), F.lit(1)).try_cast("int").alias("s"), F.get(F.split(x, "_"), F.lit(2)).try_cast("int").alias("e")))
    zipped = F.arrays_zip(F.split(F.get(f, F.lit(4)), ";").alias("read"), place(lists(5, "COORD_CONTIG_1")).alias("c1"), place(lists(6, "COORD_CONTIG_2")).alias("c2"), place(lists(7, "COORD_CONTIG_1_ON_READ")).alias("r1"), place(lists(8, "COORD_CONTIG_2_ON_READ")).alias("r2"),
        F.transform(lists(9, "CONTIG_FOR_GAPFILLING"), lambda x: F.array_remove(F.split(x, ","), "")).alias("gap"))
    return spark.read.text(path).select(*(F.get(f, F.lit(i)).alias(n) for i, n in enumerate(("c1", "o1", "c2", "o2"))), zipped.alias("reads"))


def read_windowed_coverage(spark: SparkSession, path: str) -> DataFrame:
    """id, length, left_edge, right_edge, num_windows, sample, sum_count, counts of a three-line coverage file: a header, then, for every sample, three lines per contig."""
    lines = numbered_lines(spark, path).filter("line > 0").withColumns({"rec": F.floor((F.col("line") - 1) / 3), "k": (F.col("line") - 1) % 3})
    r = lines.groupBy("file", "rec").agg(*(F.max(F.when(F.col("k") == k, F.col("value"))).alias(n) for k, n in ((0, "a"), (1, "b"), (2, "c"))))
    f = F.split("a", "\t")
    r = r.select("file", "rec", F.get(f, F.lit(0)).alias("id"), *(F.get(f, F.lit(i + 1)).try_cast("int").alias(n) for i, n in enumerate(("length", "left_edge", "right_edge", "num_windows"))), F.trim("b").try_cast("int").alias("sum_count"), F.transform(F.array_remove(F.split(F.trim("c"), r"\s+"), ""), lambda x: x.cast("int")).alias("counts"))
    return r.withColumn("sample", F.row_number().over(Window.partitionBy("file", "id").orderBy("rec")) - 1).drop("file", "rec")


def with_coverage(contigs: DataFrame, coverage: DataFrame, id: str = "id", whole: bool = True) -> DataFrame:
    """contigs with the coverage of a table (contig, coverage) where it has one; whole cuts it to an integer, as the scaffolder reads it."""
    c = F.col("_cov").cast("int").cast("double") if whole else F.col("_cov")
    rows = contigs.join(coverage.select(F.col("contig").alias(id), F.col("coverage").alias("_cov")), id, "left")
    return rows.withColumn("coverage", F.coalesce(c, "coverage")).drop("_cov")


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    """contig, length, coverage (header skipped; fractions kept)."""
    return _tsv(spark, path, "contig string, length int, coverage double", header=True)


def _headed(spark: SparkSession, path: str) -> DataFrame:
    """file, line, value and header (the text up to a space of the last line that starts with '>') of all other lines that are not empty."""
    is_header = F.startswith("value", F.lit(">"))
    rows = filled(numbered_lines(spark, path), F.when(is_header, F.regexp_extract("value", r"^>(\S+)", 1)))
    return rows.filter(~is_header & (F.trim("value") != ""))


def read_scaffolds(spark: SparkSession, path: str) -> DataFrame:
    """scaffold, pos, contig, ori, length, gap: header lines start with '>', children follow with BE or EB."""
    f = F.split("value", "\t")
    pos = F.row_number().over(Window.partitionBy("file", "header").orderBy("line"))
    ori = F.when(F.get(f, F.lit(1)) == "BE", "+").when(F.get(f, F.lit(1)) == "EB", "-")
    rows = _headed(spark, path)
    return rows.select(F.col("header").alias("scaffold"), pos.alias("pos"), F.get(f, F.lit(0)).alias("contig"), ori.alias("ori"), F.get(f, F.lit(2)).try_cast("int").alias("length"), F.get(f, F.lit(3)).try_cast("int").alias("gap"))


def read_ranked_references(spark: SparkSession, path: str) -> DataFrame:
    """cluster and refs in order; clusters start with '>'; the last one counts too."""
    rows = _headed(spark, path).withColumnRenamed("header", "cluster")
    refs = rows.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("file", "line", F.trim("value").alias("ref")))).alias("r"))
    return refs.select("cluster", F.transform("r", lambda x: x["ref"]).alias("refs"))


def read_sketch_distances(spark: SparkSession, path: str) -> DataFrame:
    """ref, query, dist, p_value, shared, total."""
    t = _tsv(spark, path, "ref string, query string, dist double, p_value double, hashes string")
    return t.select("ref", "query", "dist", "p_value", F.substring_index("hashes", "/", 1).try_cast("int").alias("shared"), F.substring_index("hashes", "/", -1).try_cast("int").alias("total"))


def read_coords(spark: SparkSession, path: str, headers: int = 4) -> DataFrame:
    """Alignment coordinates: s1, e1, s2, e2, len1, len2, idy, len_r, len_q, cov_r, cov_q (null in the short form), name_r, name_q."""
    f = F.split(F.regexp_replace(F.trim("value"), r"\s*\|\s*", "\t"), r"\s+")
    rows = numbered_lines(spark, path).filter((F.col("line") >= headers) & (F.trim("value") != ""))
    n = F.size(f)
    names = ("s1", "e1", "s2", "e2", "len1", "len2", "idy", "len_r", "len_q")
    cols = [F.get(f, F.lit(i)).try_cast("double" if c == "idy" else "int").alias(c) for i, c in enumerate(names)]
    cov = [F.when(n >= 13, F.get(f, F.lit(i)).try_cast("double")).alias(c) for i, c in ((9, "cov_r"), (10, "cov_q"))]
    return rows.select(*cols, *cov, F.get(f, n - 2).alias("name_r"), F.get(f, n - 1).alias("name_q"))


def read_kraken_report(spark: SparkSession, path: str) -> DataFrame:
    """pct, n_clade, n_direct, rank, taxid, name (trimmed, spaces as '_')."""
    t = _tsv(spark, path, "pct string, n_clade long, n_direct long, rank string, taxid string, name string")
    return t.select(F.trim("pct").cast("double").alias("pct"), "n_clade", "n_direct", "rank", "taxid", F.regexp_replace(F.trim("name"), " ", "_").alias("name"))


def read_kraken_output(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """seq and species of classified sequences; names: taxid, species."""
    t = _tsv(spark, path, "status string, seq string, taxid string, length string, hits string").filter("status = 'C'")
    return t.join(names, "taxid").select("seq", "species")


def read_bin_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """bin, completeness, contamination of a fixed-width table (columns apart by two or more spaces; rules and headers skipped)."""
    f = F.split(F.trim("value"), r"\s{2,}")
    rows = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(-+|Bin Id.*|\[.*|)\s*$"))
    n = F.size(f)
    return rows.select(F.get(f, F.lit(0)).alias("bin"), F.get(f, n - 3).try_cast("double").alias("completeness"), F.get(f, n - 2).try_cast("double").alias("contamination"))


def read_library_stats(spark: SparkSession, path: str) -> DataFrame:
    """mean, std and orientation from the prose of library files, one row for each file: of every figure, the first line that gives it."""
    patterns = {"mean": r"(?i)mean[^0-9]*?(\d+)", "std": r"(?i)(?:std|standard deviation)[^0-9]*?(\d+)", "ori": r"(?i)orientation.*?\b(in|out|forward)\b"}
    found = {n: F.nullif(F.regexp_extract("value", p, 1), F.lit("")) for n, p in patterns.items()}
    first = [F.min_by(F.when(c.isNotNull(), c), F.when(c.isNotNull(), F.col("line"))).alias(n) for n, c in found.items()]
    rows = numbered_lines(spark, path).groupBy("file").agg(*first)
    return rows.select(F.col("mean").try_cast("int").alias("mean"), F.col("std").try_cast("int").alias("std"), "ori")


def first_reads_size(spark: SparkSession, path: str, reads: int = 1000) -> int:
    """Largest length among the first reads of a FASTQ file; 0 for an empty one. Only lines of those reads pass the filter."""
    rows = numbered_lines(spark, path).filter((F.col("line") < 4 * reads) & (F.col("line") % 4 == 1))
    return rows.agg(F.coalesce(F.max(F.length("value")), F.lit(0))).first()[0]


def kmer_size(spark: SparkSession, contigs: str, flavour: str) -> int | None:
    """The k-mer size that an assembler left beside its contigs: third field of LastGraph's first line (velvet), fourth of <prefix>.preGraphBasic (soap). None without such a file."""
    folder, _, name = contigs.rpartition("/")
    side, sep, at = ("LastGraph", "\t", 2) if flavour == "velvet" else (name.split(".")[0] + ".preGraphBasic", " ", 3)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{side}" if folder else side)
    if flavour not in ("velvet", "soap", "soap_contig") or not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    fields = (spark.read.text(path.toString()).limit(1).collect() or [[""]])[0][0].split(sep)
    return int(fields[at]) if len(fields) > at and fields[at].isdigit() else None


def read_taxonomy(spark: SparkSession, path: str, prefix: int = 3) -> DataFrame:
    """seqid, genome (without its prefix), lineage, species."""
    t = _tsv(spark, path, "seqid string, lineage string")
    species = F.filter(F.split("lineage", ";"), lambda x: F.startswith(x, F.lit("s__")))
    return t.select("seqid", F.expr(f"substring(seqid, {prefix + 1})").alias("genome"), "lineage", F.regexp_replace(F.regexp_replace(F.get(species, F.lit(0)), "^s__", ""), " ", "_").alias("species"))


def read_bins(spark: SparkSession, path: str, folders: bool = False) -> DataFrame:
    """bin and contig: one FASTA file per bin, named by the file without its last extension; or, with folders, one folder per bin ('bin' or 'key=bin')."""
    from contigloom.functions.sequence import bin_of

    own = F.regexp_extract("file", r"([^/=]+)/[^/]*$", 1) if folders else bin_of(F.col("file"))
    return read_fasta(spark, path).select(own.alias("bin"), F.col("id").alias("contig"), "length")


def genome_catalog(spark: SparkSession, path: str) -> DataFrame:
    """path, n_seq, length of every FASTA file below a path."""
    return read_fasta(spark, path).groupBy(F.col("file").alias("path")).agg(F.count("*").cast("int").alias("n_seq"), F.sum("length").cast("long").alias("length"))


def assembly_size(contigs: DataFrame, length: Column | str = "length") -> DataFrame:
    """Total length and number of all records, whatever their length, in one row."""
    return contigs.agg(F.sum(length).cast("long").alias("total"), F.count("*").alias("n"))


def contigs_with_geometry(spark: SparkSession, path: str, win: int = 340, edge: int = 80, min_len: int = 500) -> DataFrame:
    return read_fasta(spark, path, min_len).withColumns(geometry_columns(F.col("length"), win, edge))


def read_config(text: str) -> dict[str, str]:
    """'KEY value', 'key=value' and '[SECTION]' lines ('#' starts a comment); keys of a section get its name and number in front."""
    out: dict[str, str] = {}
    section, seen = "", {}
    for line in text.splitlines():
        line = line.partition("#")[0].strip()
        if not line:
            continue
        if m := re.fullmatch(r"\[(\w+)\]", line):
            seen[m[1]] = seen.get(m[1], 0) + 1
            section = f"{m[1]}.{seen[m[1]]}."
            continue
        key, _, value = line.partition("=") if "=" in line else line.partition(" ")
        out[section + key.strip()] = value.strip()
    return out
