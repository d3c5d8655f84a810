"""Interval operators: islands, unions, depth, containment, overlaps and tilings. Ends are inclusive unless said otherwise."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.runtime import ship


def interval_islands(df: DataFrame, ref: str, start: str, end: str, step: int = 0, min_len: int = 0, cov: str | None = None, min_cov: float = 0.0) -> DataFrame:
    """ref, island, start, end, n of maximal runs of intervals in which the largest end so far plus step reaches the next start; kept by length and mean coverage."""
    order = Window.partitionBy(ref).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((reach + step < F.col(start)).cast("int"), F.lit(1))
    marked = df.withColumn("_new", new).withColumn("island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = marked.groupBy(ref, "island").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n"), *([F.avg(cov).alias("mean_cov")] if cov else []))
    out = out.filter(F.col("end") - F.col("start") + 1 >= min_len)
    return out.filter(F.col("mean_cov") >= min_cov) if cov else out


def union_length(df: DataFrame, ref: str, start: str, end: str) -> DataFrame:
    """ref and the number of positions that its intervals cover."""
    return interval_islands(df, ref, start, end).groupBy(ref).agg(F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("covered"))


def depth_profile(df: DataFrame, ref: str, start: str, end: str) -> DataFrame:
    """ref, pos, depth, until: stretches [pos, until) of equal depth, from the prefix sum of interval starts and ends; events are summed by position first."""
    events = df.select(ref, F.explode(F.array(F.struct(F.col(start).alias("pos"), F.lit(1).alias("d")), F.struct((F.col(end) + 1).alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    sums = events.groupBy(ref, F.col("e.pos").alias("pos")).agg(F.sum("e.d").alias("d"))
    order = Window.partitionBy(ref).orderBy("pos")
    return sums.select(ref, "pos", F.sum("d").over(order).cast("long").alias("depth"), F.lead("pos").over(order).alias("until"))


def break_zero_depth(df: DataFrame, lengths: DataFrame, ref: str, start: str, end: str, length: str = "length", min_zero: int = 1) -> DataFrame:
    """ref, piece, start, end: what is left of each reference [0, length) when stretches of at least min_zero positions without cover are cut out."""
    covered = interval_islands(df, ref, start, end, step=min_zero).select(ref, "start", "end")
    cut = covered.join(lengths.select(ref, F.col(length).alias("_len")), ref)
    low = F.when(F.col("start") < min_zero, F.lit(0)).otherwise(F.col("start"))
    high = F.when(F.col("_len") - 1 - F.col("end") < min_zero, F.col("_len") - 1).otherwise(F.col("end"))
    out = cut.select(ref, low.alias("start"), high.alias("end"))
    return out.withColumn("piece", F.row_number().over(Window.partitionBy(ref).orderBy("start")))


def containment_pairs(df: DataFrame, ref: str, start: str, end: str, id: str, bin_width: int = 1000) -> DataFrame:
    """outer and inner ids of intervals nested in another of the same reference; of equal ones the smaller id is the outer.

    Starts are binned and outer intervals repeated for the bins they span, so the range join is an equi-join on (reference, bin).
    """
    a = df.select(F.col(ref).alias("ref"), F.col(id).alias("outer"), F.col(start).alias("s1"), F.col(end).alias("e1")).withColumn("bin", F.explode(F.sequence(F.floor(F.col("s1") / bin_width), F.floor(F.col("e1") / bin_width))))
    b = df.select(F.col(ref).alias("ref"), F.col(id).alias("inner"), F.col(start).alias("s2"), F.col(end).alias("e2")).withColumn("bin", F.floor(F.col("s2") / bin_width))
    j = a.join(b, ["ref", "bin"]).filter((F.col("s1") <= F.col("s2")) & (F.col("e2") <= F.col("e1")) & (F.col("outer") != F.col("inner")))
    return j.filter((F.col("s1") < F.col("s2")) | (F.col("e2") < F.col("e1")) | (F.col("outer") < F.col("inner"))).select("ref", "outer", "inner")


def scaffold_coordinates(df: DataFrame, scaffold: str, order: list, length: str, gap: str, reverse: bool = False) -> DataFrame:
    """df with start (0-based): the running sum of lengths and gaps before each child, from the end where reverse."""
    keys = [F.col(c).desc() if reverse else F.col(c) for c in order]
    before = Window.partitionBy(scaffold).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("start", F.coalesce(F.sum(F.col(length) + F.coalesce(F.col(gap), F.lit(0))).over(before), F.lit(0)))


def forward_fill(df: DataFrame, by: list[str], order: list, value: str) -> DataFrame:
    """df with value taken from the last row above that has one (headers over their children)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(w))


def overlap_resolution(alignments: DataFrame, read: str, start: str, end: str, score: str, order: list[str], overlap: int = 200, higher_is_better: bool = True, flag: bool = False) -> DataFrame:
    """One fold along each read, in order: an alignment whose start comes before the last kept end less overlap competes with it and replaces it with a better score.

    Adds kept (and conflict, with flag: competing alignments are all left out but the first, which is marked). Start and end are extended to the whole contig
    beforehand. Reads are hashed to tasks and sorted there; a task folds over its rows and holds the rows of one read and one batch. Ties keep the earlier.
    """
    ship(alignments.sparkSession)
    names = alignments.columns

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        kept, conflict, last, last_end, last_score, last_read = [False] * len(rows), [False] * len(rows), 0, 0, 0, None
        for i, (r, s, e, x) in enumerate(zip(rows[read].tolist(), rows[start].tolist(), rows[end].tolist(), rows[score].tolist())):
            if i == 0 or r != last_read or last_end - overlap < s:
                kept[i], last, last_end, last_score, last_read = True, i, e, x, r
            elif flag:
                conflict[last], last_end = True, e
            elif (x > last_score) if higher_is_better else (x < last_score):
                kept[last], kept[i], last, last_end, last_score = False, True, i, e, x
        return rows.assign(kept=kept, conflict=conflict)

    def run(batches):
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(rows):
                continue
            whole = int((rows[read] != rows[read].iloc[-1]).sum())  # the last read may go on in the next batch
            rest = rows.iloc[whole:].reset_index(drop=True)
            if whole:
                yield fold(rows.iloc[:whole].reset_index(drop=True))
        if rest is not None and len(rest):
            yield fold(rest)

    sorted_rows = alignments.filter(F.col(read).isNotNull()).repartition(read).sortWithinPartitions(read, *order)
    return sorted_rows.mapInPandas(run, f"{', '.join(f'`{n}` {t}' for n, t in alignments.dtypes)}, kept boolean, conflict boolean").select(*names, "kept", "conflict")


def merge_consecutive(df: DataFrame, scaffold: str, order: list[str], contig: str, start: str, end: str, cstart: str, cend: str) -> DataFrame:
    """Consecutive alignments of one contig on a scaffold as one, as long as the contig's coordinates go on in one direction: scaffold, contig, run, start, end, cstart, cend, mapped, n."""
    w = Window.partitionBy(scaffold).orderBy(*order)
    lag = {c: F.lag(c).over(w) for c in (contig, cstart, cend)}
    direction = F.signum(F.col(cend) - F.col(cstart))
    onward = (lag[contig] == F.col(contig)) & (F.signum(lag[cend] - lag[cstart]) == direction) & ((F.col(cstart) - lag[cstart]) * direction > 0)
    runs = df.withColumn("_new", (~F.coalesce(onward, F.lit(False))).cast("int")).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(scaffold, contig, "run").agg(
        F.min(start).alias("start"), F.max(end).alias("end"), F.min(F.least(cstart, cend)).alias("cstart"), F.max(F.greatest(cstart, cend)).alias("cend"), F.sum(F.abs(F.col(cend) - F.col(cstart)) + 1).alias("mapped"), F.count("*").alias("n"))


def tile(runs: DataFrame, contigs: DataFrame, contig: str, length: str = "length", identity: str | None = None, own: str | None = None, min_identity: float = 0.95, min_mapped: float = 0.90) -> DataFrame:
    """Merged runs fit for tiling: identity of at least min_identity or on the contig's own scaffold, and at least min_mapped of the contig mapped; with the gap to the run before."""
    j = runs.join(contigs.select(contig, F.col(length).alias("_len")), contig)
    fine = F.lit(True) if identity is None else (F.col(identity) >= min_identity) | (F.col(own) if own else F.lit(False))
    return j.filter(fine & (F.col("mapped") >= min_mapped * F.col("_len"))).drop("_len")


def tile_gaps(tiles: DataFrame, scaffold: str, start: str = "start", end: str = "end") -> DataFrame:
    w = Window.partitionBy(scaffold).orderBy(start, end)
    return tiles.withColumn("gap", F.col(start) - F.lag(end).over(w) - 1)


def splice_tiles(consensus: DataFrame, tiles: DataFrame, scaffold: str = "scaffold", seq: str = "seq") -> DataFrame:
    """scaffold and seq with the tiles' sequences (scaffold, start, end, tile) laid over the consensus at sorted starts; what overlaps an earlier tile is clipped."""
    order = Window.partitionBy(scaffold).orderBy("start", "end", "tile")
    reach = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    clipped = tiles.withColumn("_from", F.greatest(F.col("start"), reach + 1)).filter("_from <= end")
    clipped = clipped.withColumn("_text", F.substring("tile", F.col("_from") - F.col("start") + 1, F.length("tile")))
    lists = clipped.groupBy(scaffold).agg(F.array_sort(F.collect_list(F.struct(F.col("_from").alias("a"), F.col("end").alias("b"), F.col("_text").alias("t")))).alias("_tiles"))
    joined = consensus.join(lists, scaffold, "left")
    step = lambda acc, x: F.struct(F.concat(acc["out"], F.substring(F.col(seq), acc["at"] + 1, x["a"] - acc["at"]), x["t"]).alias("out"), (x["b"] + 1).cast("int").alias("at"))
    folded = F.aggregate(F.coalesce("_tiles", F.array().cast("array<struct<a:int,b:int,t:string>>")), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step)
    return joined.withColumn("_f", folded).select(scaffold, F.concat(F.col("_f.out"), F.substring(F.col(seq), F.col("_f.at") + 1, F.length(seq))).alias(seq))
