"""Assembly statistics and robust summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nx_lx(df: DataFrame, length: str = "length", by: list[str] | None = None, x: tuple[int, ...] = (50, 90), strict: bool = False, tie: list[str] | None = None) -> DataFrame:
    """Per group: n, total, longest and Nx and Lx, the length and rank at which the running sum of descending lengths first reaches (strict: passes) x %.

    Equal lengths are summed up before the running sum, so a group's window holds a row per distinct length, not per sequence.
    """
    by = by or []
    runs = df.filter(F.col(length).isNotNull()).groupBy(*by, length).agg(F.count("*").alias("_k"))
    down = Window.partitionBy(*by).orderBy(F.col(length).desc())
    whole = Window.partitionBy(*by)
    runs = runs.withColumns({"_to": F.sum(F.col(length) * F.col("_k")).over(down), "_rank": F.sum("_k").over(down), "_all": F.sum(F.col(length) * F.col("_k")).over(whole)})
    out = [F.sum("_k").alias("n"), F.max("_all").cast("long").alias("total"), F.max(length).alias("longest")]
    for p in x:
        need = F.col("_all") * (p / 100.0)
        met = F.col("_to") > need if strict else F.col("_to") >= need
        before = F.col("_to") - F.col(length) * F.col("_k")
        gap = need - before
        steps = F.greatest(F.floor(gap / F.col(length)) + 1 if strict else F.ceil(gap / F.col(length)), F.lit(1))
        rank = F.col("_rank") - F.col("_k") + steps
        out += [F.max(F.when(met, F.col(length))).alias(f"n{p}"), F.min(F.when(met, rank)).cast("long").alias(f"l{p}")]
    return runs.groupBy(*by).agg(*out)


def assembly_stats(df: DataFrame, length: str = "length") -> DataFrame:
    """n, total, longest, numbers of sequences of at least 100 kb, 500 kb and 1 Mb, and N50, in one row."""
    counts = df.agg(*(F.count_if(F.col(length) >= t).alias(f"n_{name}") for name, t in (("100k", 100_000), ("500k", 500_000), ("1m", 1_000_000))))
    return nx_lx(df, length, x=(50,)).drop("l50").crossJoin(counts)  # two single rows


def size_classes(df: DataFrame, length: str, n_col: str | None = None, limits: tuple[int, ...] = (0, 100, 500, 1000, 10_000, 100_000, 1_000_000)) -> DataFrame:
    """Cumulative classes: for every limit the number, bases and Ns of sequences of at least that length; one pass, no join."""
    n = F.col(n_col) if n_col else F.lit(0)
    sums = df.agg(*(F.struct(F.lit(t).alias("at_least"), F.count_if(F.col(length) >= t).alias("n"), F.coalesce(F.sum(F.when(F.col(length) >= t, F.col(length))), F.lit(0)).cast("long").alias("bases"), F.coalesce(F.sum(F.when(F.col(length) >= t, n)), F.lit(0)).cast("long").alias("n_bases")).alias(f"c{t}") for t in limits))
    return sums.select(F.explode(F.array(*(F.col(f"c{t}") for t in limits))).alias("c")).select("c.*")


def weighted_coverage(df: DataFrame, by: list[str], coverage: str, length: str, digits: int = 2) -> DataFrame:
    """Length-weighted mean coverage; a null coverage counts as 0."""
    return df.groupBy(*by).agg(F.round(F.sum(F.coalesce(coverage, F.lit(0.0)) * F.col(length)) / F.sum(length), digits).alias("coverage"))


def iqr_stats(df: DataFrame, value: str, by: list[str], k: float = 3.0) -> DataFrame:
    """Quartiles by nearest rank (0-based index int(n / 4) and int(3 n / 4)), and number, mean and population deviation of the values within k interquartile ranges of them."""
    order = Window.partitionBy(*by).orderBy(value)
    ranked = df.filter(F.col(value).isNotNull()).withColumn("_i", F.row_number().over(order) - 1).withColumn("_n", F.count("*").over(Window.partitionBy(*by)))
    q = ranked.groupBy(*by).agg(*(F.max(F.when(F.col("_i") == F.floor(F.col("_n") * s), F.col(value))).alias(name) for s, name in ((0.25, "q1"), (0.75, "q3"))))
    wide = (F.col("q3") - F.col("q1")) * k
    kept = df.join(q, by).filter(F.col(value).between(F.col("q1") - wide, F.col("q3") + wide))
    return kept.groupBy(*by, "q1", "q3").agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def distribution(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Empirical distribution: share of each value in its group."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"))
    return counts.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def inverse_variance(df: DataFrame, by: list[str], value: str, std: str) -> DataFrame:
    """Inverse-variance weighted mean and its deviation; members of deviation 0 are left out."""
    w = 1.0 / (F.col(std) * F.col(std))
    return df.filter(F.col(std) > 0).groupBy(*by).agg((F.sum(F.col(value) * w) / F.sum(w)).alias("mean"), (1.0 / F.sqrt(F.sum(w))).alias("std"), F.count("*").alias("n"))


def majority(df: DataFrame, by: list[str], value: str, exclude: str | None = None) -> DataFrame:
    """Most frequent value of each group; ties go to the smaller value."""
    rows = df.filter(F.col(value) != exclude) if exclude is not None else df
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.max("n").alias("n"))


def running_position(df: DataFrame, by: list[str], distance: str, step: str) -> DataFrame:
    """Position as the mean of distances weighted by one over the number of steps."""
    return df.groupBy(*by).agg((F.sum(F.col(distance) / F.col(step)) / F.sum(1.0 / F.col(step))).alias("position"), F.min(distance).alias("least"))


def read_library_totals(reads: DataFrame, by: list[str], length: str) -> DataFrame:
    """Reads in millions, bases in Gbp and mean length in kbp, as text with two decimals."""
    return reads.groupBy(*by).agg(F.format_string("%.2f", F.count("*") / 1e6).alias("m_reads"), F.format_string("%.2f", F.sum(length) / 1e9).alias("gbp"), F.format_string("%.2f", F.avg(length) / 1e3).alias("kbp"))


def unseen(samples: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Samples that an earlier output lacks (for incremental appends)."""
    return samples.join(done.select(key).distinct(), key, "left_anti")


def top_within(df: DataFrame, by: list[str], order: list, k: int, name: str = "rank") -> DataFrame:
    """The k first rows of each group with their rank; the limit applies before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= k)


def sequence_stats(seqs: DataFrame, seq: str = "seq", min_contig: int = 500, min_scaffold: int = 500) -> DataFrame:
    """Scaffold and contig figures: scaffolds of at least min_scaffold bases, and the pieces between their runs of N of at least min_contig."""
    s = seqs.select(F.col(seq).alias("s"), F.length(seq).alias("length"))
    scaffolds = nx_lx(s.filter(F.col("length") >= min_scaffold), "length").withColumn("kind", F.lit("scaffold"))
    pieces = s.select(F.explode(F.array_remove(F.split("s", "[Nn]+"), "")).alias("c")).select(F.length("c").alias("length"))
    contigs = nx_lx(pieces.filter(F.col("length") >= min_contig), "length").withColumn("kind", F.lit("contig"))
    return scaffolds.unionByName(contigs)
