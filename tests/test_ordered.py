"""Order-dependent operators over several blocks, with one hot key, against plain loops."""

import math
import random
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clipwarden.operators import dedup, joins, logs, merge, ordered, select

N = 3000


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(
        {
            # two thirds of all rows share one key
            "k": np.where(rng.random(N) < 0.66, "hot", rng.integers(0, 9, N).astype(str)),
            "o": rng.permutation(N),
            "v": np.round(rng.random(N) * 50, 2),
        }
    )
    return spark.createDataFrame(pdf), pdf.sort_values(["k", "o"]).reset_index(drop=True)


def ordered_pdf(df):
    return df.toPandas().sort_values(["k", "o"]).reset_index(drop=True)


def test_rank_and_running_sum(rows):
    df, pdf = rows
    got = ordered_pdf(ordered.rank_within(df, ["k"], ["o"], "r", partitions=7))
    assert (got["r"] == pdf.groupby("k").cumcount() + 1).all()
    got = ordered_pdf(ordered.running_sums(df, ["k"], ["o"], {"s": F.col("v")}, partitions=7))
    np.testing.assert_allclose(got["s"], pdf.groupby("k")["v"].cumsum())


def test_running_sum_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, o int")
    got = {(r["k"], r["o"]): r["r"] for r in ordered.rank_within(df, ["k"], ["o"], "r", partitions=3).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 1): 1}


def test_quantiles_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 5.0)], "k string, v double")
    got = {r["k"]: r["m"] for r in ordered.exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert got == {None: 1.5, "a": 5.0}


def test_global_index(rows):
    df, pdf = rows
    got = ordered.global_index(df, ["v", "k", "o"], "i", partitions=6).toPandas().sort_values(["v", "k", "o"])
    assert got["i"].tolist() == list(range(N))


def test_rolling_mean_crosses_blocks(rows):
    df, pdf = rows
    got = ordered_pdf(ordered.rolling_mean(df, ["k"], ["o"], "v", 100, block_rows=130))
    want = pdf.groupby("k")["v"].rolling(100, min_periods=1).mean().to_numpy()
    np.testing.assert_allclose(got["rolling_mean"], want)


def test_exact_quantiles(rows):
    df, pdf = rows
    got = ordered.exact_quantiles(df, ["k"], "v", {"a": 0.05, "b": 0.5, "c": 0.99}, partitions=6).toPandas().set_index("k")
    want = pdf.groupby("k")["v"].quantile([0.05, 0.5, 0.99]).unstack()
    np.testing.assert_allclose(got.loc[want.index].to_numpy(), want.to_numpy())
    one = ordered.exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert one == pytest.approx(np.quantile(pdf["v"], 0.5))


def test_ema_composes_blocks(rows):
    df, pdf = rows
    got = ordered_pdf(logs.ema(df, ["k"], ["o"], "v", 0.98, partitions=8))
    want = np.concatenate([logs.ema_values(g["v"].to_numpy(), 0.98, None) for _, g in pdf.groupby("k")])
    np.testing.assert_allclose(got["ema"], want, rtol=1e-12)


def test_thin_overlaps_is_the_greedy_scan(rows):
    df, pdf = rows
    timed = df.withColumn("start", F.col("o") * 0.7)
    got = ordered_pdf(dedup.thin_overlaps(timed, "k", "start", 4.5, ["o"], partitions=8))
    want = []
    for _, g in pdf.groupby("k"):
        last = None
        for s in g["o"] * 0.7:
            want.append(last is None or s - last >= 4.5)
            last = s if want[-1] else last
    assert got["kept"].tolist() == want


def test_early_stop_over_blocks(rows):
    df, pdf = rows
    typed = df.withColumn("o", F.col("o").cast("bigint"))
    trace = logs.early_stop(typed, ["k"], "o", "v", warmup=100, min_delta=0.5, patience=400, partitions=8)
    got = ordered_pdf(trace)
    want = []
    for _, g in pdf.groupby("k"):
        _, flags = logs.early_stop_scan(None, g["o"].tolist(), g["v"].tolist(), 100, 0.5, 400)
        want += [f[0] for f in flags]
    assert got["status"].tolist() == want
    assert "stopped" in want


def test_early_stop_golden(spark):
    df = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate([1.0, 0.9, 0.899, 0.898])], "run int, step bigint, v double")
    trace = logs.early_stop(df, ["run"], "step", "v", 0, 0.005, 2)
    r = logs.early_stop_result(trace, ["run"], "step").first()
    assert (r["stop_step"], r["best_step"], r["best_loss"]) == (4, 2, 0.9)


def test_ema_golden(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (1, 3, 3.0)], "run int, step int, v double")
    got = [round(r["ema"], 6) for r in logs.ema(df, ["run"], ["step"], "v").orderBy("step").collect()]
    assert got == [1.0, 1.02, 1.0596]


def plain_dedup(hashes, threshold):
    out, last = [], None
    for h in hashes:
        if h is None:
            out.append("kept")
            last = None
        elif last is None or sum((a ^ b).bit_count() for a, b in zip(h, last)) / 3 > threshold:
            out.append("kept")
            last = h
        else:
            out.append("removed")
    return out


def test_perceptual_dedup_over_blocks(spark):
    rng = np.random.default_rng(3)
    n, rows, want = 900, [], {}
    per = {}
    big = 1 << 62
    for i in range(n):
        src = "hot" if rng.random() < 0.6 else f"s{i % 3}"
        near = per.get(src, [None])[-1]
        base = near or tuple(int(rng.integers(0, big)) for _ in range(3))
        flips = [int(sum(1 << int(b) for b in rng.integers(0, 62, 7))) for _ in range(3)]
        h = None if rng.random() < 0.03 else tuple(b ^ f for b, f in zip(base, flips))
        per.setdefault(src, [None]).append(h)
        rows.append((f"c{i:05d}", src, float(i), *(h or (None, None, None)), "cap"))
    for src in per:
        ids = [r[0] for r in rows if r[1] == src]
        want.update(zip(ids, plain_dedup(per[src][1:], 8.0)))
    df = spark.createDataFrame(
        rows,
        "clip_id string, source_video_id string, clip_start_sec double, first_hash bigint, middle_hash bigint, last_hash bigint, caption string",
    )
    got = dedup.perceptual_dedup(df, 8.0, partitions=9)
    assert {r["clip_id"]: r["decision"] for r in got.collect()} == want
    assert set(want.values()) == {"kept", "removed"}
    blank = dedup.blank_removed_captions(got).filter("decision = 'removed'").select("caption").distinct().collect()
    assert [r[0] for r in blank] == [""]


def plain_unique(ids):
    seen, out = set(), []
    for i in ids:
        new, k = i, 1
        while new in seen:
            new, k = f"{i}_{k}", k + 1
        seen.add(new)
        out.append(new)
    return out


@pytest.mark.parametrize(
    "ids",
    [
        ["a", "a", "a_1", "a"],
        ["a_1", "a", "a", "a_1", "a", "a_2", "a_1_1", "a_1"],
        ["x", "y", "x_1", "x_2", "x", "x", "x_01", "x", "y"],
        ["m", "n", "o"],
    ],
)
def test_unique_ids_golden(spark, ids):
    df = spark.createDataFrame(list(enumerate(ids)), "o int, id string")
    got = [r["new_id"] for r in merge.unique_ids(df, "id", ["o"], partitions=3).orderBy("o").collect()]
    assert got == plain_unique(ids)


def test_unique_ids_random(spark):
    rng = np.random.default_rng(11)
    pool = ["a", "a", "a", "a_1", "a_2", "a_3", "a_1_1", "a_1_2", "b", "b_1", "a_07"]
    ids = [pool[i] for i in rng.integers(0, len(pool), 120)]
    df = spark.createDataFrame(list(enumerate(ids)), "o int, id string")
    got = [r["new_id"] for r in merge.unique_ids(df, "id", ["o"], partitions=4).orderBy("o").collect()]
    assert got == plain_unique(ids)
    assert len(set(got)) == len(got)


def test_overlap_counts_golden_and_naive(spark):
    df = spark.createDataFrame([("k", s) for s in (0.0, 4.0, 4.5, 9.0)], "key string, start double")
    got = {r["start"]: r["overlaps"] for r in joins.overlap_counts(df, "key", "start").collect()}
    assert got == {0.0: 1, 4.0: 2, 4.5: 1, 9.0: 0}
    rng = np.random.default_rng(2)
    pts = [("h" if rng.random() < 0.7 else "c", float(np.round(rng.random() * 40, 1))) for _ in range(300)]
    df = spark.createDataFrame(pts, "key string, start double")
    want = 0
    for i, a in enumerate(pts):
        for b in pts[i + 1 :]:
            want += a[0] == b[0] and abs(a[1] - b[1]) < 4.5
    assert joins.overlap_counts(df, "key", "start").agg(F.sum(F.expr("copies * overlaps"))).first()[0] == 2 * want
    left, right = pts[:100], pts[100:]
    mk = lambda p: spark.createDataFrame(p, "key string, start double")
    touch = sum(any(a[0] == b[0] and abs(a[1] - b[1]) < 4.5 for b in right) for a in left)
    r = joins.overlap_count(mk(left), mk(right), "key", "start").first()
    assert (r["counted_side"], r["overlaps"]) == ("a", touch)
    cross = sum(a[0] == b[0] and abs(a[1] - b[1]) < 4.5 for a in left for b in right)
    counts = joins.cross_overlap_counts(mk(left), mk(right), "key", "start")
    assert counts.agg(F.sum(F.expr("copies * overlaps"))).first()[0] == cross


def test_overlap_count_swaps_to_the_smaller_side(spark):
    a = spark.createDataFrame([("k", 0.0), ("k", 1.0), ("k", 2.0)], "key string, start double")
    b = spark.createDataFrame([("k", 0.5)], "key string, start double")
    r = joins.overlap_count(a, b, "key", "start").first()
    assert (r["counted_side"], r["overlaps"]) == ("b", 1)


@pytest.mark.parametrize("n, f, want", [(20, 0.05, 1), (1, 0.05, 0), (2, 0.0, 0), (2, 1.0, 1), (50, 0.05, 2)])
def test_validation_count(n, f, want):
    assert select.validation_count(n, f) == want


def test_split_is_disjoint_and_reproducible(spark):
    df = spark.range(200)
    a = {r["id"]: r["split"] for r in select.split_rows(df, ["id"], 0.1, partitions=4).collect()}
    b = {r["id"]: r["split"] for r in select.split_rows(df.repartition(5), ["id"], 0.1).collect()}
    assert a == b and list(a.values()).count("val") == 20


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    out = action()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    spark.sparkContext.setJobGroup("", "")
    return n, out


@pytest.mark.parametrize("kind", ["one reference", "fresh references", "walk"])
def test_hot_key_folds_take_few_rounds(spark, kind):
    """One source over 24 and over 96 blocks: hardly more jobs, and the plain fold's decisions."""
    rng = np.random.default_rng(4)
    hashes, now = [], [0, 0, 0]
    for i in range(960):
        if kind == "fresh references":
            now = rng.integers(0, 1 << 62, 3).tolist()
        elif kind == "walk" and i % 3 == 0:
            now = [h ^ (1 << int(rng.integers(0, 62))) for h in now]
        hashes.append(now)
    rows = [("s", float(i), f"c{i}", *h) for i, h in enumerate(hashes)]
    df = spark.createDataFrame(rows, "source_video_id string, clip_start_sec double, clip_id string, first_hash bigint, middle_hash bigint, last_hash bigint")
    seen = {}
    for blocks in (24, 96):
        run = lambda n=blocks: ordered_rows(dedup.perceptual_dedup(df, 4.0, partitions=n))
        seen[blocks], got = jobs_of(spark, f"{kind} {blocks}", run)
        assert got == plain_dedup([tuple(h) for h in hashes], 4.0)
    assert seen[96] <= 2 * seen[24]


def ordered_rows(df):
    return [r["decision"] for r in df.orderBy("clip_start_sec").collect()]


def test_thinning_of_a_hot_key_takes_few_rounds(spark):
    rng = np.random.default_rng(9)
    at = np.sort(rng.random(2000) * 900)
    df = spark.createDataFrame([("k", float(a)) for a in at], "key string, start double")
    want, last = [], None
    for a in at:
        want.append(last is None or a - last >= 4.5)
        last = a if want[-1] else last
    seen = {}
    for blocks in (24, 96):
        run = lambda n=blocks: [r["kept"] for r in dedup.thin_overlaps(df, "key", "start", 4.5, partitions=n).orderBy("start").collect()]
        seen[blocks], got = jobs_of(spark, f"thin {blocks}", run)
        assert got == want
    assert seen[96] <= 2 * seen[24]

def test_neighbours_of_a_hot_key(spark):
    """Both directions against plain loops; one key spans 24 blocks, long stretches have no place at all."""
    rnd = random.Random(8)
    rows = {(k, float(v)): (rnd.random() < 0.6, v % 97 > 90 or (v > 3000 and v % 2 == 0)) for k in ("hot", None) for v in rnd.sample(range(6000), 2500)}
    rows |= {(f"k{rnd.randint(0, 400)}", float(rnd.randint(0, 50))): (True, rnd.random() < 0.5) for _ in range(1500)}
    df = spark.createDataFrame([(k, v, a, t) for (k, v), (a, t) in rows.items()], "key string, v double, asked boolean, there boolean")
    want = set()
    for (k, v), (a, _) in rows.items():
        if a:
            own = [x for (key, x), (_, t) in rows.items() if key == k and t]
            want.add((k, v, max((x for x in own if x < v), default=None), min((x for x in own if x > v), default=None)))
    for blocks in (1, 24):
        got = {tuple(r) for r in ordered.neighbours(df, ["key"], "v", "asked", "there", partitions=blocks).collect()}
        assert got == want
    assert ordered.neighbours(df.limit(0), ["key"], "v", "asked", "there").count() == 0


def test_run_monitor_over_blocks_and_batches(spark):
    """One run holds most rows and spans many blocks; its rows arrive in batches, the answer equals one plain pass."""
    from clipwarden.operators.logs import early_stop_scan, ema_values
    from clipwarden.streaming import streams

    rnd = random.Random(2)
    runs = {1: 900, 2: 40, 3: 1, None: 30}
    rows = [(r, s, rnd.random() - s / 800) for r, n in runs.items() if r is not None for s in range(n)]
    states = spark.createDataFrame([], "run bigint, ema double, best double, best_step bigint, misses bigint, stopped bigint")
    got = []
    for low, high in ((0, 300), (300, 301), (301, 1000)):
        part = spark.createDataFrame([r for r in rows if low <= r[1] < high], "run bigint, step bigint, loss double")
        found, states = streams.watched(part, states, 0.9, 3, 0.01, 40, block_rows=60)
        again, _ = streams.watched(part, states.limit(0), 0.9, 3, 0.01, 40) if low == 0 else (found, None)
        assert {(r.run, r.step, r.status) for r in again.collect()} == {(r.run, r.step, r.status) for r in found.collect()}
        got += found.collect()
        states = spark.createDataFrame(states.collect(), states.schema)
    want = {}
    for run in (1, 2, 3):
        own = sorted((s, v) for r, s, v in rows if r == run)
        emas = ema_values(np.array([v for _, v in own]), 0.9, None)
        _, flags = early_stop_scan(None, [s for s, _ in own], [v for _, v in own], 3, 0.01, 40)
        want |= {(run, s): (e, f[0]) for (s, _), e, f in zip(own, emas, flags)}
    assert {(r.run, r.step): r.status for r in got} == {k: v[1] for k, v in want.items()}
    assert all(abs(r.loss_ema - want[r.run, r.step][0]) < 1e-9 for r in got)


def test_many_runs_at_once_against_one_by_one():
    """The bulk forms of the folds, runs with and without a state row, null losses, ties and late stops."""
    draw, parts = random.Random(3), []
    for run in range(400):
        n, state = draw.randint(1, 9), draw.random() < 0.5
        losses = [draw.choice([float("nan"), round(draw.uniform(0, 1), 1)]) for _ in range(n)]
        seed = (draw.choice([None, 0.5]), draw.choice([None, 3]), draw.randint(0, 2), draw.choice([None, None, 4]), 0.25) if state else None
        parts.append((seed, list(range(draw.randint(0, 3), 12))[:n], losses[:n]))
    rows = [(seed is not None and i < 0, s, v, seed) for seed, steps, losses in parts
            for i, s, v in ([(-1, 0, float("nan"))] if seed else []) + list(zip(range(99), steps, losses))]
    sizes = np.array([len(steps) + (seed is not None) for seed, steps, _ in parts])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    first = np.array([r[0] for r in rows])
    nums = lambda i, f: np.array([f if not r[0] or r[3][i] is None else r[3][i] for r in rows])
    absent = lambda i: np.ma.masked_array(nums(i, 0).astype("int64"), [not r[0] or r[3][i] is None for r in rows])
    got = logs.early_stop_many(
        np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), starts, sizes, 1, 0.05, 2,
        (first, nums(0, np.nan).astype(float), absent(1), nums(2, 0).astype("int64"), absent(3)),
    )
    values = np.where(first, nums(4, 0.0).astype(float), [r[2] for r in rows])
    averages = logs.ema_many(values, starts, sizes, 0.9)
    want, smooth = [], []
    for seed, steps, losses in parts:
        state = None
        if seed:
            state = (math.inf if seed[0] is None else seed[0], *seed[1:4])
            want.append(("state", *seed[:4]))
        smooth += [*([seed[4]] if seed else []), *logs.ema_values(np.array(losses), 0.9, seed[4] if seed else None)]
        for s, v in zip(steps, losses):
            state, [(flag, best, at, misses)] = logs.early_stop_scan(state, [s], [v], 1, 0.05, 2)
            want.append((flag, best, at, misses, state[3]))
    assert list(zip(*[v.tolist() for v in got.values()])) == want
    np.testing.assert_array_equal(averages, np.array(smooth))


def test_fold_calls_do_not_grow_with_keys(spark, tmp_path):
    """Keys that lie within a batch share one call; borders look at one key per block."""
    df = spark.range(6000).select((F.col("id") / 3).cast("bigint").alias("k"), "id")

    def step(state, rows):
        with open(tmp_path / uuid.uuid4().hex, "w"):
            return len(rows) + (state or 0), {"n": list(range(1 + (state or 0), 1 + (state or 0) + len(rows)))}

    def bulk(rows, starts, sizes):
        return {"n": np.arange(len(rows)) - np.repeat(starts, sizes) + 1}

    got = ordered.carry_fold(df, ["k"], ["id"], ["id"], step, {"n": "bigint"}, partitions=4, bulk=bulk)
    assert got.filter("n <> id % 3 + 1").count() == 0 and got.count() == 6000
    assert len(list(tmp_path.iterdir())) < 40


def test_contested_ids_of_many_families(spark):
    """Ids whose suffixed forms are held by others, null order values, levels of suffixes; against a plain loop."""
    draw = random.Random(8)
    ends = ["", "", "_1", "_2", "_1_1", "_4", "_2_1_1"]
    rows = [(None if i == 0 else i, f"c{draw.randrange(60)}{draw.choice(ends)}") for i in range(600)]
    rows[0] = (None, "c7")
    taken, want = set(), []
    for _, name in rows:
        new, k = name, 0
        while new in taken:
            k += 1
            new = f"{name}_{k}"
        taken.add(new)
        want.append(new)
    got = merge.unique_ids(spark.createDataFrame(rows, "o int, id string"), "id", ["o"], partitions=3).orderBy("o").collect()
    assert [r["new_id"] for r in got] == want
