"""Windowed coverage and the dispersion estimates over it.

Long tables hold one row per (contig, sample, window): id, sample, win, n. Positions are 0-based.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def geometry_columns(length: Column, win: int = 340, edge: int = 80) -> dict[str, Column]:
    """num_windows, left_edge, right_edge and modified_length of contigs: whole windows, centred between the edges."""
    n = F.greatest(F.floor((length - 2 * edge) / win), F.lit(0)).cast("int")
    rest = (length - n * win).cast("int")
    left = F.floor(rest / 2).cast("int")
    right = (length - 1 - (rest - left)).cast("int")
    return {"num_windows": n, "left_edge": left, "right_edge": right, "modified_length": (right - left + 1).cast("int")}


def window_geometry(contigs: DataFrame, length: str = "length", win: int = 340, edge: int = 80) -> DataFrame:
    """contigs with their window geometry."""
    return contigs.withColumns(geometry_columns(F.col(length), win, edge))


def window_counts(hits: DataFrame, contigs: DataFrame, win: int = 340, id: str = "id", pos: str = "pos", sample: str | None = None) -> DataFrame:
    """id, [sample], win, n: hits in every window of every contig, zero where there are none.

    contigs: id, left_edge, num_windows. Hits outside the windows do not count. One aggregation by (id, sample, window), combined
    before its shuffle; the grid of windows is made from the contigs alone and left-joined.
    """
    keys = [id, *([sample] if sample else [])]
    g = contigs.select(id, "left_edge", "num_windows")
    at = F.floor((F.col(pos) - F.col("left_edge")) / win).cast("int")
    counted = hits.join(g, id).withColumn("win", at).filter((F.col("win") >= 0) & (F.col("win") < F.col("num_windows"))).groupBy(*keys, "win").agg(F.count("*").alias("n"))
    grid = g.filter("num_windows > 0").select(id, F.explode(F.sequence(F.lit(0), F.col("num_windows") - 1)).alias("win"))
    if sample:
        grid = grid.crossJoin(F.broadcast(hits.select(sample).distinct()))  # one row per sample
    return grid.join(counted, [*keys, "win"], "left").select(*keys, "win", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def contig_moments(windows: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Sum, number of windows, mean and population variance of each contig's counts."""
    return windows.groupBy(*keys).agg(F.sum(n).alias("sum_count"), F.count("*").alias("windows"), F.avg(n).alias("mean"), F.var_pop(n).alias("variance"))


def arrival_rate(counts: DataFrame, by: list[str], count: str = "sum_count", length: str = "modified_length") -> DataFrame:
    """Mean arrival rate: total count over total length."""
    return counts.groupBy(*by).agg((F.sum(count) / F.sum(length)).alias("rate"))


def integer_median(values: Column) -> Column:
    """Median of an array of integers; for an even number the integer mean of the two middle ones, truncated."""
    s, n = F.sort_array(values), F.size(values)
    mid = F.floor(n / 2).cast("int")
    odd = F.get(s, mid)
    even = F.get(s, mid - 1) + F.get(s, mid)
    return F.when(n % 2 == 1, odd).otherwise((even / 2).cast("long"))


def moment_dispersion(moments: DataFrame, min_len: int = 10_000, length: str = "length") -> DataFrame:
    """Contigs with r = mean^2 / (variance - mean), where the variance exceeds the mean and the length reaches min_len."""
    m, v = F.col("mean"), F.col("variance")
    return moments.filter((F.col(length) >= min_len) & (v > m) & (m > 0)).withColumn("r", m * m / (v - m))


def trimmed_dispersion(dispersed: DataFrame, by: list[str], key: str, trim: float = 0.1, default_r: float = 50.0, default_min: float = 20.0) -> DataFrame:
    """Least-squares r and least kept r of each group, after the share trim of contigs with the smallest and largest r is left out.

    r = sum(m^4) / sum(m^2 * v - m^3). Groups where nothing is left get the defaults. Ties of r go by key.
    """
    m, v = F.col("mean"), F.col("variance")
    order = Window.partitionBy(*by).orderBy("r", key)
    ranked = dispersed.withColumn("rn", F.row_number().over(order)).withColumn("cnt", F.count("*").over(Window.partitionBy(*by)))
    cut = F.floor(F.col("cnt") * trim)
    kept = (F.col("rn") > cut) & (F.col("rn") <= F.col("cnt") - cut)
    sums = ranked.groupBy(*by).agg(F.sum(F.when(kept, m**4)).alias("a"), F.sum(F.when(kept, m * m * v - m**3)).alias("b"), F.min(F.when(kept, F.col("r"))).alias("min_r"))
    return sums.select(*by, F.coalesce(F.try_divide("a", "b"), F.lit(default_r)).alias("r"), F.coalesce("min_r", F.lit(default_min)).alias("min_r"))


def dispersed_variance(windows: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Population variance after each count is joined by itself times and over the square root of two, as pseudo-samples."""
    spread = windows.withColumn("x", F.explode(F.array(F.col(n).cast("double"), F.col(n) * F.sqrt(F.lit(2.0)), F.col(n) / F.sqrt(F.lit(2.0)))))
    return spread.groupBy(*keys).agg(F.avg("x").alias("mean"), F.var_pop("x").alias("variance"))


def window_outliers(counts: Column, factor: float = 3.0) -> Column:
    """Counts of an array below factor times its median."""
    s, n = F.sort_array(counts), F.size(counts)
    mid = F.floor(n / 2).cast("int")
    median = F.when(n % 2 == 1, F.get(s, mid).cast("double")).otherwise((F.get(s, mid - 1) + F.get(s, mid)) / 2.0)
    return F.filter(counts, lambda x: x < median * factor)


def local_modes(df: DataFrame, by: list[str], order: str, value: str, half: int = 5) -> DataFrame:
    """Rows whose value is the first largest of the frame of half rows on either side; the first and last half rows of a group never are."""
    ordered = Window.partitionBy(*by).orderBy(order)
    frame = ordered.rowsBetween(-half, half)
    before = ordered.rowsBetween(-half, -1)
    marked = df.withColumns({"_top": F.max(value).over(frame), "_before": F.max(value).over(before), "_i": F.row_number().over(ordered), "_n": F.count("*").over(Window.partitionBy(*by))})
    keep = (F.col(value) == F.col("_top")) & (F.col("_before").isNull() | (F.col("_before") < F.col(value))) & (F.col("_i") > half) & (F.col("_i") <= F.col("_n") - half)
    return marked.filter(keep).drop("_top", "_before", "_i", "_n")


def long_read_coverage(alignments: DataFrame, read: str, contig: str, order: list[str], start: str, end: str, contig_length: str) -> DataFrame:
    """Coverage of each contig by the first alignment of each (read, contig): aligned read bases over contig length."""
    first = F.row_number().over(Window.partitionBy(read, contig).orderBy(*order)) == 1
    one = alignments.withColumn("_first", first).filter("_first")
    return one.groupBy(contig).agg(F.max(contig_length).alias("length"), (F.sum(F.col(end) - F.col(start)) / F.max(contig_length)).alias("coverage"))


def outlier_fraction(contigs: DataFrame, cluster: str, length: str, coverage: str, factor: float = 2.0, min_len: int = 200_000) -> DataFrame:
    """Per cluster: length, mean coverage by length, length of contigs outside [m / factor, m * factor], and that share; counted when the length reaches min_len."""
    mean = contigs.groupBy(cluster).agg((F.sum(F.col(coverage) * F.col(length)) / F.sum(length)).alias("mean_cov"))
    out = (F.col(coverage) > F.col("mean_cov") * factor) | (F.col(coverage) < F.col("mean_cov") / factor)
    sums = contigs.join(mean, cluster).groupBy(cluster).agg(F.sum(length).alias("total_len"), F.first("mean_cov").alias("mean_cov"), F.coalesce(F.sum(F.when(out, F.col(length))), F.lit(0)).alias("outlier_len"))
    return sums.withColumn("fraction", F.col("outlier_len") / (F.col("total_len") + 1)).withColumn("counted", F.col("total_len") >= min_len)
