"""Writers of sequence files and tables, and the stage registry of a resumable run."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigloom.operators.edges import distance_bucket


def fasta_lines(seqs: DataFrame, id: str = "id", seq: str = "seq", **metadata: str) -> DataFrame:
    """value: '>id key_value ...' and the sequence; null metadata is written as NA."""
    extra = [F.concat(F.lit(f"{k}_"), F.coalesce(F.col(c).cast("string"), F.lit("NA"))) for k, c in metadata.items()]
    return seqs.select(F.concat(F.lit(">"), F.concat_ws(" ", F.col(id).cast("string"), *extra), F.lit("\n"), F.col(seq)).alias("value"))


def write_fasta(seqs: DataFrame, path: str, id: str = "id", seq: str = "seq", **metadata: str) -> None:
    fasta_lines(seqs, id, seq, **metadata).write.mode("overwrite").text(path)


def write_fasta_by(seqs: DataFrame, path: str, by: str, id: str = "id", seq: str = "seq") -> None:
    """One folder of FASTA files per value of by; null as 'unclustered'."""
    rows = seqs.withColumn(by, F.coalesce(F.col(by).cast("string"), F.lit("unclustered")))
    lines = rows.select(by, F.concat(F.lit(">"), F.col(id).cast("string"), F.lit("\n"), F.col(seq)).alias("value"))
    lines.write.mode("overwrite").partitionBy(by).text(path)


def write_edges_by_distance(edges: DataFrame, path: str) -> None:
    """Edges in one folder per distance stratum; those outside all strata are left out."""
    edges.withColumn("lib", distance_bucket(F.col("dist"))).filter("lib is not null").write.mode("overwrite").partitionBy("lib").option("sep", "\t").csv(path)


def split_rejected(rows: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """(rows of code 0 without it, the others with it)."""
    return rows.filter(F.col(code) == 0).drop(code), rows.filter(F.col(code) != 0)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A tab-separated table with a header, nulls as NA."""
    w = df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA")
    (w.partitionBy(*partition_by) if partition_by else w).csv(path)


def stats_lines(stats: DataFrame) -> DataFrame:
    """The one row of an assembly summary as 'label: value' lines."""
    cells = [F.format_string(f"{c}: %s", F.col(c).cast("string")) for c in stats.columns]
    return stats.select(F.explode(F.array(*cells)).alias("value"))


def with_header(lines: DataFrame, header: str, value: str = "value") -> DataFrame:
    """Lines of text with a header before the first of each task's, so that every file begins with it."""
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    return lines.withColumn("_first", first).select(F.when(F.col("_first"), F.concat(F.lit(header + "\n"), F.col(value))).otherwise(F.col(value)).alias("value"))


def write_windowed_coverage(rows: DataFrame, path: str, header: str = "contigs") -> None:
    """Three lines for each row of read_windowed_coverage()'s columns: id and geometry, the sum, the counts; a header line begins each file."""
    geometry = F.concat_ws("\t", *(F.col(c).cast("string") for c in ("id", "length", "left_edge", "right_edge", "num_windows")))
    counts = F.array_join(F.transform("counts", lambda x: x.cast("string")), " ")
    lines = rows.select(F.concat_ws("\n", geometry, F.col("sum_count").cast("string"), counts).alias("value"))
    with_header(lines, header).write.mode("overwrite").text(path)


def scaffold_lines(scaffolds: DataFrame, coverage: str | None = None) -> DataFrame:
    """value: '>scaffold', total length and coverage, then a line for each child: contig, BE or EB, length, gap."""
    child = F.concat_ws("\t", F.col("contig").cast("string"), F.when(F.col("ori") == "+", "BE").otherwise("EB"), F.col("length").cast("string"), F.coalesce("gap", F.lit(0)).cast("string"))
    cov = F.round(F.avg(coverage), 2) if coverage else F.lit(1.0)
    rows = scaffolds.groupBy("scaffold").agg(F.sum("length").alias("_size"), cov.alias("_cov"), F.array_sort(F.collect_list(F.struct("pos", child.alias("line")))).alias("_lines"))
    head = F.concat(F.lit(">"), F.col("scaffold").cast("string"), F.lit("\tlength: "), F.col("_size").cast("string"), F.lit("\tcov: "), F.col("_cov").cast("string"))
    return rows.select(F.concat_ws("\n", head, F.array_join(F.transform("_lines", lambda x: x["line"]), "\n")).alias("value"))


def dot_lines(edges: DataFrame) -> DataFrame:
    """value: an edge of a graph description for drawing, labelled by orientations, distance and support."""
    label = F.format_string("%s%s %d (%d)", "o1", "o2", F.col("dist").cast("long"), F.col("support").cast("long"))
    return edges.select(F.format_string('"%s" -- "%s" [label="%s"];', F.col("c1").cast("string"), F.col("c2").cast("string"), label).alias("value"))


class Stages:
    """Runs named stages whose results are Parquet tables below a folder; finished ones are read, and once one runs all later ones do. The seconds of
    each run are appended to a table beside them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.stale = spark, folder.rstrip("/"), False

    def _done(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def run(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.folder}/{name}"
        if self.stale or not self._done(path):
            self.stale = True
            began = time.time()
            make().write.mode("overwrite").parquet(path)
            row = self.spark.createDataFrame([(name, time.time() - began)], "stage string, seconds double")
            row.coalesce(1).write.mode("append").parquet(f"{self.folder}/_timings")
        return self.spark.read.parquet(path)

    def timings(self) -> DataFrame:
        """stage and seconds of every run so far."""
        return self.spark.read.parquet(f"{self.folder}/_timings")
