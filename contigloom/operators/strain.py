"""Strain separation by coverage modes. One species' windows are one group."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.runtime import ship


def density(values: np.ndarray, points: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian kernel density at equally spaced points, three bandwidths beyond the data; rule-of-thumb bandwidth
    0.9 * min(deviation, interquartile range / 1.34) * n^(-1/5)."""
    v = np.asarray(values, float)
    sd = v.std(ddof=1) if len(v) > 1 else 0.0
    q1, q3 = np.percentile(v, [25, 75])
    spread = min(sd, (q3 - q1) / 1.34) or sd or abs(v[0]) or 1.0
    h = 0.9 * spread * len(v) ** -0.2
    x = np.linspace(v.min() - 3 * h, v.max() + 3 * h, points)
    distinct, times = np.unique(v, return_counts=True)
    y = np.zeros(points)
    for i in range(0, len(distinct), 4096):
        y += (np.exp(-0.5 * ((x[:, None] - distinct[None, i : i + 4096]) / h) ** 2) * times[i : i + 4096]).sum(1)
    return x, y / (len(v) * h * math.sqrt(2 * math.pi))


def modes(values: np.ndarray, span: int = 11) -> list[float]:
    """Places where the density is the first largest of the span points around, ascending."""
    x, y = density(values)
    half = span // 2
    return [float(x[i]) for i in range(half, len(y) - half) if y[i] == y[i - half : i + half + 1].max() and (y[i - half : i] < y[i]).all()]


def mean_of_mode(mode: float, r: float) -> float:
    """Mean of a negative binomial with dispersion r whose mode is given."""
    return mode * r / (r - 1) if r > 1 else mode


def nb_quantile(p: float, mean: float, r: float) -> int:
    """Least k whose cumulative probability reaches p, for a negative binomial of the given mean and dispersion."""
    if mean <= 0:
        return 0
    log_pmf = r * math.log(r / (r + mean))
    step, total, k = math.log(mean / (r + mean)), 0.0, 0
    while True:
        total += math.exp(log_pmf)
        if total >= p or k > mean + 60 * math.sqrt(mean + mean * mean / r) + 100:
            return k
        log_pmf += step + math.log((r + k) / (k + 1))
        k += 1


def interval(mean: float, r: float) -> tuple[int, int]:
    return nb_quantile(0.02, mean, r), nb_quantile(0.98, mean, r)


def peel(contigs: list, lengths: np.ndarray, counts: list[np.ndarray], win: int, r: float, low: int, high: int, ratio: tuple[float, float] = (0.7, 1.3)) -> list[int]:
    """Strain number (from 1; 0 for none) of each contig: the highest coverage mode first, accepted if the mean of the windows inside its interval
    agrees with it and covers enough sequence (high for the first, low for later ones); r is then estimated anew (500 where the variance
    is below the mean) and free contigs inside the new interval join. Without an accepted mode all contigs are strain 1."""
    medians = np.array([np.median(c) if len(c) else 0.0 for c in counts])
    strain = np.zeros(len(contigs), int)
    accepted = 0
    every = np.concatenate(counts) if len(counts) else np.zeros(0)
    for mode in reversed(modes(every)) if len(every) else ():
        mean = mean_of_mode(mode, r)
        if mean <= 0:
            continue
        lo, hi = interval(mean, r)
        inside = [c[c < 3 * m] for c, m, s in zip(counts, medians, strain) if s == 0 and lo < m < hi]
        pool = np.concatenate(inside) if inside else np.zeros(0)
        if not len(pool):
            continue
        least = low if accepted else high
        if not (ratio[0] < pool.mean() / mean < ratio[1] and len(pool) * win > least):
            continue
        var = pool.var()
        again = pool.mean() ** 2 / (var - pool.mean()) if var > pool.mean() else 500.0
        lo, hi = interval(mean_of_mode(mode, again), again)
        chosen = (strain == 0) & (lo < medians) & (medians < hi)
        if lengths[chosen].sum() > least:
            accepted += 1
            strain[chosen] = accepted
    return strain.tolist() if accepted else [1] * len(contigs)


def peel_strains(windows: DataFrame, win: int, r: float, species: str = "species", contig: str = "contig", length: str = "length", counts: str = "counts", low: int = 100_000, high: int = 500_000) -> DataFrame:
    """species, contig, strain of every contig (0: in no strain) from species, contig, length and an array of window counts."""
    ship(windows.sparkSession)
    kinds = dict(windows.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(contig, kind="stable")
        found = peel(pdf[contig].tolist(), pdf[length].to_numpy(float), [np.asarray(c, float) for c in pdf[counts]], win, r, low, high)
        return pd.DataFrame({"species": pdf[species].to_numpy(), "contig": pdf[contig].to_numpy(), "strain": found})

    return windows.select(species, contig, length, counts).groupBy(species).applyInPandas(run, f"species {kinds[species]}, contig {kinds[contig]}, strain int")


def coverage_interval(contigs: DataFrame, mean: float, r: float, median: str = "median") -> DataFrame:
    """Contigs whose median count lies strictly inside the 2 to 98 % interval of a strain."""
    lo, hi = interval(mean, r)
    return contigs.filter((F.col(median) > lo) & (F.col(median) < hi))


def strain_candidates(clusters: DataFrame, references: DataFrame, contig: str = "contig", cluster: str = "cluster", length: str = "length", species: str = "species", min_len: int = 1_000_000, min_len_no_ref: int = 2_500_000) -> DataFrame:
    """species and total length worth a strain analysis: more than min_len of contigs, or min_len_no_ref for clusters without a reference (named by the cluster)."""
    j = clusters.join(references.select(cluster, species), cluster, "left")
    named = F.coalesce(F.col(species), F.concat(F.lit("cluster_"), F.col(cluster).cast("string")))
    sums = j.groupBy(named.alias(species), F.col(species).isNull().alias("_free")).agg(F.sum(length).cast("long").alias("total_len"), F.count("*").alias("n"))
    return sums.filter(F.col("total_len") > F.when(F.col("_free"), min_len_no_ref).otherwise(min_len)).drop("_free")


def strain_edges(edges: DataFrame, strains: DataFrame, coverage: str = "coverage") -> DataFrame:
    """Edges inside one strain, and those rescued between a strain's contig and one of lower coverage in no strain; with strain and rescued.

    strains: contig, strain, coverage.
    """
    a, b = (strains.select(F.col("contig").alias(f"c{i}"), F.col("strain").alias(f"_s{i}"), F.col(coverage).alias(f"_v{i}")) for i in (1, 2))
    e = edges.join(a, "c1").join(b, "c2")
    same = (F.col("_s1") == F.col("_s2")) & (F.col("_s1") > 0)
    rescued = ((F.col("_s1") > 0) & (F.col("_s2") == 0) & (F.col("_v2") < F.col("_v1"))) | ((F.col("_s2") > 0) & (F.col("_s1") == 0) & (F.col("_v1") < F.col("_v2")))
    return e.filter(same | rescued).withColumns({"strain": F.greatest("_s1", "_s2"), "rescued": ~same}).drop("_s1", "_s2", "_v1", "_v2")


def residual_pool(contigs: DataFrame, strains: DataFrame, contig: str = "contig") -> DataFrame:
    """Contigs that no strain took, back in the single-strain pool."""
    return contigs.join(strains.filter("strain > 0").select(contig), contig, "left_anti")
