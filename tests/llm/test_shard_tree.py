"""The k-d tree against a sequential one, at many shards, and its handling of groups of copies."""

import time

import numpy as np
import pytest

from contigloom.llm import kd_shards

DOCS = "doc_id long, text string, lang string, source string"


def table(spark, n, hot=0, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, "the same text again " * 3 if i < hot else f"{i} " + "x" * int(rng.integers(1, 300)), ["en", "de", None][i % 3], "big" if i % 3 else f"s{i % 11}") for i in range(n)]
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.mark.parametrize("shards", [2, 7, 13])
def test_cuts_against_a_sequential_tree(spark, shards):
    raw, dims = kd_shards.points(table(spark, 1200, hot=400), "doc_id", "text", ["lang", "source"])
    rows, placed, room, share = kd_shards.keyed(raw, dims, shards)
    start = [(tuple(r[f"k{i}"] for i in range(dims)), r["size"], r["row"]) for r in rows.collect()]
    done, cuts = kd_shards.build(rows, dims, room, share)
    got = {r["row"]: r["node"] for r in done.collect()}
    want = {}

    def split(low, high, own):
        if high - low == 1 or not own:
            want.update((row, low) for _, _, row in own)
            return
        wide = [max(k[i] for k, _, _ in own) // 2**42 - min(k[i] for k, _, _ in own) // 2**42 for i in range(dims)]
        dim, cut = cuts[low, high]
        assert wide[dim] == max(wide) and dim == wide.index(max(wide))
        mid = low + (high - low) // 2
        wanted = sum(n for _, n, _ in own) * (sum(room[low:mid]) / sum(room[low:high]) if sum(room[low:high]) else 0.5)
        keys = sorted((k[dim], n) for k, n, _ in own)
        sums = np.concatenate([[0], np.cumsum([n for _, n in keys])])
        ends = [i for i in range(len(keys) + 1) if i in (0, len(keys)) or keys[i - 1][0] != keys[i][0]]  # equal keys stay together
        best = min(abs(float(sums[i]) - wanted) for i in ends)
        left = [x for x in own if x[0][dim] <= cut]
        assert abs(sum(n for _, n, _ in left) - wanted) <= best + kd_shards.FINE * share
        split(low, mid, left)
        split(mid, high, [x for x in own if x[0][dim] > cut])

    split(0, shards, start)
    assert got == want
    assert placed.count() + len(got) == 1200


def test_sizes_are_even_at_two_thousand_shards(spark):
    began = time.time()
    out = kd_shards.kd_shards(table(spark, 40_000, hot=13_000), shards=2000).toPandas()
    mean = out["size"].sum() / 2000
    sums = out.groupby("shard")["size"].sum()
    largest = out["size"].max()
    assert len(sums) == 2000 and (sums - mean).abs().max() <= 0.02 * mean + largest
    assert (out.groupby("shard")["slot"].max() + 1 == out.groupby("shard")["slot"].count()).all()
    assert time.time() - began < 300


def test_sizes_are_within_two_hundredths(spark):
    out = kd_shards.kd_shards(table(spark, 20_000, hot=3000), shards=9).toPandas()
    mean = out["size"].sum() / 9
    assert (out.groupby("shard")["size"].sum() - mean).abs().max() <= 0.02 * mean


def test_a_group_that_fits_a_shard_stays_whole(spark):
    rows = [(i, "g" * 50 if i < 300 else f"other {i} " + "y" * 40, "en", f"s{i % 5}") for i in range(2000)]
    out = kd_shards.kd_shards(spark.createDataFrame(rows, DOCS), shards=5).toPandas()
    assert out[out["doc_id"] < 300]["shard"].nunique() == 1
    mean = out["size"].sum() / 5
    assert (out.groupby("shard")["size"].sum() - mean).abs().max() <= 0.02 * mean


def test_packing():
    got = dict(kd_shards.packed([(1, 6), (2, 5), (3, 5), (4, 4), (5, 11)], [0, 1], 10.0))
    assert got == {5: None, 1: 0, 2: 1, 3: 1, 4: 0}
    assert dict(kd_shards.packed([(1, 6)], [], 10.0)) == {1: None}
