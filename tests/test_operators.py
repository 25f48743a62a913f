"""Small frames for the rules that the tables do not show: nulls, ties, overflow, gaps, guards."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tidepanel.functions import bigint
from tidepanel.functions import columns as fc
from tidepanel.operators import extract, features, metrics, panels, profile, quality, ranks, splits
from tidepanel.sources import files
from tidepanel.streaming import buckets

T0 = dt.datetime(2024, 1, 1)


def hours(*h):
    return [T0 + dt.timedelta(hours=x) for x in h]


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize(("cell", "digits"), [("0", "0"), ("007", "7"), ("-5", "-5"), (" 12 ", "12"), (str(10**38), str(10**38)), (str(2**256 - 1), str(2**256 - 1)), ("", None), ("nan", None), ("1e3", None), ("1.5", None), (None, None), ("-0", "0")])
def test_big_integer_cells(spark, cell, digits):
    assert one(spark, bigint.parsed("x"), cell) == digits


def test_big_integer_sums(spark):
    import random

    rng = random.Random(3)
    values = [rng.getrandbits(rng.choice([3, 60, 128, 250])) for _ in range(200)] + [10**18 - 1] * 50 + [2**256 - 1]
    df = spark.createDataFrame([(str(v),) for v in values], "x string")
    r = df.agg(bigint.total("x").alias("s"), bigint.largest("x").alias("hi"), bigint.smallest("x").alias("lo")).first()
    assert (int(r.s), int(r.hi), int(r.lo)) == (sum(values), max(values), min(values))
    assert df.limit(0).agg(bigint.total("x").alias("s")).first().s is None
    pair = spark.createDataFrame([("5", None), (None, "9"), (None, None)], "p string, q string")
    assert pair.agg(bigint.signed_total("p", "q").alias("s")).first().s == "-4"
    for trial in range(20):
        plus, minus = ([rng.getrandbits(rng.choice([3, 60, 128, 256])) for _ in range(rng.randint(0, 4))] for _ in range(2))
        pair = spark.createDataFrame([(str(v), None) for v in plus] + [(None, str(v)) for v in minus] + [(None, None)], "p string, q string")
        got = pair.agg(bigint.signed_total("p", "q").alias("s")).first().s
        assert got == (str(sum(plus) - sum(minus)) if plus or minus else None)


@pytest.mark.parametrize("exact", [False, True])
def test_wide_amounts_in_panels(spark, tokens, exact):
    """Digit strings and full-width decimals: sums beyond 38 digits, extremes as numbers, negative net flows."""
    big, huge = "9" * 38, 2**256 - 1
    rows = lambda values: events(spark, [(T0, i, i, 1, i % 2, 0, 0.5, 1) for i in range(len(values))]).drop("amount").withColumn("amount", F.get(F.array(*map(F.lit, values)), F.col("block").cast("int")))
    r = extract.supply_withdraw(rows([big, big, None]), rows([str(huge), "007"]), tokens, exact=exact).first()
    assert (r.supply_amount_raw, r.withdrawal_amount_raw, r.net_supply_flow_raw) == (str(2 * int(big)), str(huge + 7), str(2 * int(big) - huge - 7)) and r.unique_suppliers == 2
    full = rows([big, big]).withColumn("amount", F.col("amount").cast("decimal(38,0)"))
    assert extract.borrow_repay(full, full.limit(0), tokens, exact=exact).first().net_debt_flow_raw == str(2 * int(big))
    calls = rows(["9", str(10**40), None]).withColumnRenamed("amount", "hf")
    r = extract.user_account(calls, ["rate"], "hf", exact=exact).first()
    assert (r.min_health_factor, r.max_health_factor, r.call_count, r.sampled_users, r.avg_rate) == ("9", str(10**40), 3, 2, 0.5)
    legs = rows([big, big]).select("time", "block", F.col("asset").alias("collateral_asset"), F.col("asset").alias("debt_asset"), F.col("amount").alias("collateral_amount"), F.lit("5").alias("debt_amount"), "user", F.lit(7).alias("liquidator"), F.lit(True).alias("receive_token"))
    r = extract.liquidation(legs, tokens, exact=exact).first()
    assert (r.collateral_amount_raw, r.debt_covered_raw, r.collateral_tx_count, r.debt_tx_count, r.liquidation_tx_count, r.receive_token_count, r.unique_liquidated_users, r.unique_liquidators) == (str(2 * int(big)), "10", 2, 2, 4, 2, 2, 1)
    scaled = extract.flashloan(rows([str(10**40)]).withColumn("premium", F.lit("1")), tokens, exact=exact, scale=True).first()
    assert (scaled.flashloan_amount, scaled.flashloan_premium) == (1e38, 0.01)


def _shuffled(spark):
    """Bytes that all stages so far have shuffled or spilled."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return sum(s.shuffleWriteBytes() + s.diskBytesSpilled() for s in (stages.apply(i) for i in range(stages.size())))


def test_liquidations_shuffle_actors_without_amounts(spark, tokens):
    n = 200_000
    key = lambda x: F.pmod(F.xxhash64("id", F.lit(x)), F.lit(10**9))
    rows = spark.range(n).select((F.lit(T0) + F.make_dt_interval(days=(key(1) % 50).cast("int"))).alias("time"), F.col("id").alias("block"), *((key(i) % 10).alias(f"{leg}_asset") for i, leg in ((2, "collateral"), (3, "debt"))), *(key(i).alias(f"{leg}_amount") for i, leg in ((4, "collateral"), (5, "debt"))), key(6).alias("user"), key(7).alias("liquidator"), F.lit(True).alias("receive_token"))
    before = _shuffled(spark)
    out = extract.liquidation(rows, tokens, "1 day", exact=True).agg(F.sum("liquidation_tx_count").alias("n"), F.sum("debt_covered_raw").alias("debt"), F.sum("unique_liquidated_users").alias("u"), F.sum("unique_liquidators").alias("l")).first()
    own = _shuffled(spark) - before
    assert out.n == 2 * n and out.debt == rows.agg(F.sum("debt_amount")).first()[0] and min(out.u, out.l) > 1.8 * n
    assert own < 75 * n


def test_liquidations_without_assets_or_actors(spark, tokens):
    kind = "time timestamp_ntz, block long, collateral_asset long, debt_asset long, collateral_amount long, debt_amount long, user string, liquidator long, receive_token boolean"
    rows = [(T0, 1, 1, 2, 10, 5, "a", 7, True), (T0, 2, 1, 1, 20, 6, "b", 7, None), (T0, 3, None, 1, 30, None, None, 8, False), (T0, 4, None, None, None, 9, "a", None, True)] + [(None, 5, 1, 2, 1, 1, "a", 7, True)]  # the last has no bucket
    got = extract.liquidation(spark.createDataFrame(rows, kind), tokens, "1 day", exact=True).collect()
    names = ["collateral_amount_raw", "debt_covered_raw", "collateral_tx_count", "debt_tx_count", "liquidation_tx_count", "receive_token_count", "latest_liquidation_block", "unique_liquidated_users", "unique_liquidators"]
    assert {(r.time_bucket, r.asset): tuple(r[c] for c in names) for r in got} == {
        (T0, 1): (30, 6, 2, 2, 4, 1, 3, 2, 2), (T0, 2): (0, 5, 0, 1, 1, 0, 1, 1, 1), (T0, None): (30, 9, 2, 1, 3, 1, 4, 1, 1),
    }


@pytest.mark.parametrize(("digits", "decimals", "value"), [("12345", 3, 12.345), ("-12", 4, -0.0012), ("7", 0, 7.0), (str(10**45 + 1), 45, 1.0), (None, 2, None)])
def test_shifted_point(spark, digits, decimals, value):
    assert one(spark, fc.shifted("x", decimals), digits) == value


def test_bucket_edges(spark):
    times = [T0, T0 + dt.timedelta(hours=1, minutes=59, seconds=59, milliseconds=999), T0 + dt.timedelta(hours=2), T0 + dt.timedelta(hours=23, minutes=59, seconds=59), T0 + dt.timedelta(days=1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert [r.b for r in df.select(fc.bucket("t").alias("b")).collect()] == hours(0, 0, 2, 22, 24)


def events(spark, rows):
    df = spark.createDataFrame(rows, "time timestamp_ntz, block long, idx long, asset long, user long, amount long, rate double, mode int")
    return df


@pytest.fixture
def tokens(spark):
    return spark.createDataFrame([(1, "A", 2)], "asset long, asset_symbol string, decimals int")


def test_one_sided_buckets_and_ties(spark, tokens):
    borrow = events(spark, [(T0, 5, 1, 1, 7, 100, 0.1, 1), (T0, 5, 2, 1, 7, 50, 0.2, 2), (T0, 4, 9, 1, 8, 1, 0.9, 2)])
    repay = events(spark, [(hours(2)[0], 6, 1, 1, 7, 30, None, None), (T0, 9, 9, 2, 3, 4, 0.0, None)])
    rows = {(r.time_bucket, r.asset): r for r in extract.borrow_repay(borrow, repay, tokens, exact=True).collect()}
    r = rows[T0, 1]
    assert (r.borrow_amount_raw, r.repay_amount_raw, r.repay_tx_count, r.last_borrow_rate, r.unique_borrowers, r.stable_borrow_count, r.asset_symbol) == (151, None, 0, 0.2, 2, 1, "A")
    r = rows[hours(2)[0], 1]
    assert (r.borrow_amount_raw, r.net_debt_flow_raw, r.borrow_tx_count, r.last_borrow_rate) == (None, -30, 0, None)
    assert rows[T0, 2].asset_symbol is None


def test_config_state(spark, tokens):
    changes = [(hours(-50)[0], 1, 1, "ltv", 70), (hours(2)[0], 2, 1, "ltv", 75), (hours(3)[0], 3, 1, "ltv", 80), (hours(6)[0], 4, 2, "cap", 5)]
    df = spark.createDataFrame(changes, "time timestamp_ntz, block long, asset long, param string, value long")
    rows = {(r.time_bucket, r.asset): r for r in extract.reserve_config(df, tokens, ["ltv", "cap", "none"], str(T0), str(hours(6)[0])).collect()}
    assert [rows[h, 1].ltv for h in hours(0, 2, 4, 6)] == [70, 80, 80, 80]
    assert rows[hours(2)[0], 1].config_event_count == 2 and rows[T0, 1].config_event_count == 0
    assert {a for _, a in rows} == {1, 2} and rows[hours(6)[0], 2].cap == 5 and rows[T0, 1].none == 0 and (T0, 2) not in rows


def test_decimals_and_prices(spark):
    panel = spark.createDataFrame([(T0, 1, 500), (T0, 2, 7), (T0, 3, None), (hours(2)[0], 1, 100)], "time_bucket timestamp_ntz, asset long, amount_raw long")
    book = spark.createDataFrame([(1, 2, "raw_token_amount", 1), (1, 9, "raw_token_amount", 2), (2, 0, "block_number", 1), (3, 1, "raw_token_amount", 1)], "asset long, decimals int, unit string, ord int")
    own = panels.scale_by_decimals(panel, panels.decimals_of(book, "ord"))
    assert {(r.asset, r.amount) for r in own.collect()} == {(1, 5.0), (1, 1.0), (2, None), (3, None)}
    prices = spark.createDataFrame([(T0, 1, 10.0, None)], "time_bucket timestamp_ntz, asset long, avg_price_usd double, avg_price_eth double")
    out = panels.aggregate_by_time_bucket(panels.multiply_by_price(own, prices, ["amount"]), ["amount_value_usd", "amount_value_eth"])
    assert {(r.time_bucket, r.amount_value_usd, r.amount_value_eth) for r in out.collect()} == {(T0, 50.0, 0.0), (hours(2)[0], 0.0, 0.0)}


def test_resampling_fills_gaps(spark):
    df = spark.createDataFrame([(hours(1)[0], 1), (hours(13)[0], 2)], "time_bucket timestamp_ntz, x long")
    assert [(r.time_bucket, r.x) for r in panels.aggregate_by_time_bucket(df, ["x"], freq="6 hours").orderBy("time_bucket").collect()] == list(zip(hours(0, 6, 12), (1, 0, 2)))


def test_rolling_and_ranks(spark):
    df = spark.createDataFrame([(1, h, x) for h, x in zip(hours(0, 2, 4, 6, 8), (1.0, None, 3.0, 4.0, 5.0))], "asset long, time_bucket timestamp_ntz, x double")
    got = [r.y and round(r.y, 5) for r in df.select("time_bucket", features.rolling_std("x", 4, 2).alias("y")).orderBy("time_bucket").collect()]
    assert got == [None, None, 1.41421, 1.52753, 1.0]
    ties = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 3.0), (4, None)], "i long, x double").withColumn("g", F.lit(1))
    assert [r.y for r in ties.select("i", features.average_rank("x", ("g",)).alias("y")).orderBy("i").collect()] == [2.5, 1.0, 2.5, None]


def test_terciles(spark):
    tied = spark.createDataFrame([(float(x),) for x in (1, 1, 1, 1, 2, 3)], "x double")
    with pytest.raises(PySparkException, match="tercile edges must differ"):
        splits.terciles(tied, F.col("x"), ("a", "b", "c")).collect()
    plain = spark.createDataFrame([(float(x),) for x in range(9)] + [(None,)], "x double")
    counts = {r.label: r.n for r in splits.terciles(plain, F.col("x"), ("a", "b", "c")).groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert counts == {"a": 3, "b": 3, "c": 3, None: 1}


def test_clusters():
    class Table(list):
        def collect(self):
            return self

    from collections import namedtuple

    Row = namedtuple("Row", "col_a col_b r")
    table = Table([Row("a", "b", 0.9), Row("a", "c", 0.1), Row("b", "c", -0.95), Row("a", "d", None), Row("b", "d", 0.0), Row("c", "d", 0.2)])
    assert splits.correlation_clusters(table, "abcd", 3) == {"cluster_1": ["b", "c"], "cluster_2": ["a"], "cluster_3": ["d"]}
    assert splits.correlation_clusters(table, "abcd", 3, absolute=False) == {"cluster_1": ["a", "b"], "cluster_2": ["c"], "cluster_3": ["d"]}
    assert splits.correlation_clusters(table, "abcd", 1, linkage="average")["cluster_1"] == ["d", "a", "b", "c"]


@pytest.mark.parametrize(("name", "scans"), [("v_e1_protocol_frame", 3), ("v_t0_schema", 1), ("v_t1_domain", 1), ("v_t2_failing_examples", 1)])
def test_checks_share_their_scans(spark, sf_dir, capsys, name, scans):
    from tidepanel.plans.registry import QUERIES

    QUERIES[name](spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") <= scans and "NestedLoop" not in plan and "CartesianProduct" not in plan


def plain_clusters(columns, far, n, linkage):
    """Pairs of clusters are compared member by member, again for every merge."""
    groups = [[c] for c in columns]
    how = {"complete": max, "single": min, "average": lambda xs: sum(xs) / len(xs)}[linkage]
    while len(groups) > n:
        apart = lambda p: how([far[frozenset((x, y))] for x in groups[p[0]] for y in groups[p[1]]])
        a, b = min(((i, j) for i in range(len(groups)) for j in range(i + 1, len(groups))), key=apart)
        groups = [g for k, g in enumerate(groups) if k not in (a, b)] + [groups[a] + groups[b]]
    return [sorted(g) for g in sorted(groups, key=len, reverse=True)]


@pytest.mark.parametrize("linkage", ["complete", "single", "average"])
def test_clusters_member_by_member(spark, linkage):
    import random

    rng = random.Random(3)
    columns = [f"c{i}" for i in range(14)]
    rows = [(a, b, rng.uniform(-1, 1)) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    r = spark.createDataFrame(rows, "col_a string, col_b string, r double")
    for n in (1, 4, 9):
        got = splits.correlation_clusters(r, columns, n, linkage=linkage)
        assert sorted(map(sorted, got.values())) == sorted(plain_clusters(columns, {frozenset((a, b)): 1 - abs(x) for a, b, x in rows}, n, linkage))
    coherent = {x.cluster: x.mean_r for x in splits.coherence(r, splits.correlation_clusters(r, columns, 4)).collect()}
    of = {frozenset((a, b)): x for a, b, x in rows}
    for name, own in splits.correlation_clusters(r, columns, 4).items():
        inner = [of[frozenset((a, b))] for i, a in enumerate(own) for b in own[i + 1 :]]
        assert (name in coherent) == bool(inner) and (not inner or abs(coherent[name] - sum(inner) / len(inner)) < 1e-12)


def test_clusters_of_the_whole_table(spark, sf_dir):
    """c02 and r04 against correlations by numpy and clusters member by member."""
    import numpy as np
    from tidepanel.plans.registry import QUERIES

    x = np.array([list(r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("embedding").collect()], float)
    names, m = [f"e{i}" for i in range(64)], np.corrcoef(x.T)
    for query, n, absolute in (("c02_correlation_clusters", 5, True), ("r04_columns_by_correlation", 4, False)):
        far = {frozenset((names[i], names[j])): 1 - (abs(m[i, j]) if absolute else m[i, j]) for i in range(64) for j in range(i)}
        want = plain_clusters(names, far, n, "complete")
        rows = QUERIES[query](spark, sf_dir).collect()
        if n == 5:
            got = {}
            for r in rows:
                got.setdefault(r.cluster, []).append(r.column)
            assert sorted(map(sorted, got.values())) == sorted(want)
        else:
            at = {c: i for i, c in enumerate(names)}
            means = sorted(round(float(np.mean([m[at[a], at[b]] for i, a in enumerate(g) for b in g[i + 1 :]])), 6) for g in want if len(g) > 1)
            assert sorted(r.mean_r for r in rows if r.cluster != "overall") == means


def test_metrics_guards(spark):
    rows = [("flat", i, 2.0) for i in range(5)] + [("one", 0, 1.0), ("none", 0, None), ("bad", 0, float("nan")), ("bad", 1, float("inf"))]
    out = {r.series: r for r in metrics.shape(spark.createDataFrame(rows, "series string, ord int, x double")).collect()}
    assert set(out) == {"flat", "one"} and out["flat"].moment_skewness is None and out["flat"].shannon_entropy == 0.0 and out["flat"].hill_tail_index is None
    assert abs(out["flat"].gini_coefficient) < 1e-12 and out["one"].excess_kurtosis is None


def test_drawdown_of_returns_with_total_loss(spark):
    df = spark.createDataFrame([("s", i, x) for i, x in enumerate((0.5, -0.5, 1.0, -1.0, 3.0))], "series string, ord int, x double")
    assert [round(r.dd, 9) for r in metrics.drawdowns(df).orderBy("ord").collect()] == [0.0, -0.5, 0.0, -1.0, -1.0]


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_places_by_ranges(spark, monkeypatch, keys):
    import random

    monkeypatch.setattr(ranks, "PART", 9)
    monkeypatch.setattr(ranks, "WHOLE", 20)
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), float(rng.randint(0, 40)), rng.randint(1, 9)) for _ in range(300)] + [("one", 3.0, 2), ("a", None, 1)]
    df = spark.createDataFrame(rows, "g string, x double, w long").groupBy("g", "x").agg(F.sum("w").alias("w"))
    got = ranks.placed(df if keys else df.groupBy("x").agg(F.sum("w").alias("w")), keys, "x", "w").collect()
    for r in got:
        own = [(x, w) for g, x, w in rows if x is not None and (not keys or g == r.g)]
        assert r._begin == sum(w for x, w in own if x < r.x) and r._n == sum(w for _, w in own)
    whole = ranks.points(ranks.placed(df, ["g"], "x", "w"), ["g"], "x", {"lo": 0.1, "median": 0.5, "hi": 0.99}, "w").collect()
    for r in whole:
        own = sorted(x for g, x, w in rows if g == r.g and x is not None for _ in range(w))
        for name, share in (("lo", 0.1), ("median", 0.5), ("hi", 0.99)):
            at = share * (len(own) - 1)
            low = own[int(at)]
            assert abs(r[name] - (low + (at - int(at)) * (own[min(int(at) + 1, len(own) - 1)] - low))) < 1e-9


def test_streamed_fill_equals_the_batch(spark, tmp_path):
    """Changes in files of random order, some later than the watermark's bound allows none: the closed buckets are those of a walk over all changes."""
    import random

    from tidepanel.streaming import fill

    rng = random.Random(6)
    changes = [(T0 + dt.timedelta(minutes=rng.randrange(48 * 60)), i, rng.choice("ab"), float(rng.randrange(50))) for i in range(300)]
    changes.sort(key=lambda r: r[0] + dt.timedelta(minutes=rng.randrange(170)))  # at most three hours late
    schema = "time timestamp, block long, asset string, value double"
    for k in range(6):
        spark.createDataFrame(changes[50 * k : 50 * k + 50] + [(None, 0, "a", 1.0), (T0, 0, None, 1.0)], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        (tmp_path / "in" / f"{k}").rename(tmp_path / f"in{k}")
    (tmp_path / "all").mkdir(exist_ok=True)
    for k in range(6):
        file = next((tmp_path / f"in{k}").glob("*.parquet"))
        file.rename(tmp_path / "all" / f"{k}.parquet")
        import os

        os.utime(tmp_path / "all" / f"{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/all")
    buckets.to_table(fill.filled(stream, late="3 hours"), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination(300)
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    got = {(r.asset, r.time_bucket): (r.value, r.fell) for r in rows}
    assert len(got) == len(rows)
    for asset in "ab":
        own = sorted((t, i, v) for t, i, a, v in changes if a == asset)
        first = min(t for t, _, _ in own)
        b, last, n = dt.datetime(2024, 1, 1, first.hour // 2 * 2) + dt.timedelta(days=first.day - 1), None, 0
        end = max(t for a, t in got if a == asset)
        while b <= end:
            inside = [(i, v) for t, i, v in own if b <= t < b + dt.timedelta(hours=2)]
            value = max(inside)[1] if inside else last
            assert got[asset, b] == (value, last is not None and value < last)
            b, last, n = b + dt.timedelta(hours=2), value, n + 1
        assert n == sum(a == asset for a, _ in got) and n >= 20


def test_committed_versions(spark, tmp_path):
    from tidepanel.sources import versions

    root, df = f"{tmp_path}/tables", spark.range(5)
    with pytest.raises(KeyError):
        versions.read(spark, root, "t")
    df.write.parquet(f"{root}/data/t_1-killed")  # data without a manifest
    with pytest.raises(KeyError):
        versions.read(spark, root, "t")
    assert versions.write(df, root, "t", "1") and not versions.write(df.limit(1), root, "t", "1")
    assert versions.write(spark.range(5, 7), root, "t", "2", append=True) and not versions.write(spark.range(5, 7), root, "t", "2", append=True)
    assert sorted(r.id for r in versions.read(spark, root, "t").collect()) == list(range(7)) and versions.read(spark, root, "t", "1").count() == 5
    assert versions.write(spark.range(2).withColumn("x", F.lit("a")), root, "t", "3", append=True)
    assert versions.newest(spark, root, "t").rows == 9 and versions.read(spark, root, "t").where("x is null").count() == 7
    with pytest.raises(ValueError):
        versions.write(df, root, "t", "0", append=True)
    assert versions.write(df.limit(0), root, "empty", "1") and versions.read(spark, root, "empty").count() == 0


def test_layouts_are_pruned(spark, tmp_path, capsys):
    from tidepanel.sources import versions

    n = 3000
    ev = spark.range(n).select((F.lit(T0) + F.make_dt_interval(hours=(F.col("id") % 240).cast("int"))).alias("time"), (F.col("id") % 50).alias("asset"), F.col("id").alias("amount"))
    assert versions.laid_out(ev, f"{tmp_path}/laid", "events", "1", rows_per_file=500)
    laid = versions.read(spark, f"{tmp_path}/laid", "events")
    some = versions.between(laid, "2024-01-03 05:00:00", "2024-01-05 02:00:00")
    assert some.count() == ev.where("time >= timestamp_ntz'2024-01-03 05:00:00' and time < timestamp_ntz'2024-01-05 02:00:00'").count()
    some.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-03" in plan and "PushedFilters: [IsNotNull(time)" in plan
    assert len(some.inputFiles()) == len(laid.inputFiles())  # of the relation; the scan lists fewer
    assert {r.date.day for r in some.select("date").distinct().collect()} == {3, 4, 5}
    universe = ev.select("asset").distinct().withColumn("n", F.col("asset") * 1).where("n < 3")
    own = versions.of_universe(laid, universe)
    assert own.count() == ev.where("asset < 3").count()
    own.explain()
    assert "dynamicpruning" in capsys.readouterr().out


def test_stored_tables_can_be_cleared(spark):
    from tidepanel.sources import stored

    stored.clear(spark)
    kept = stored.stored(spark.range(9), "some")
    assert kept.count() == 9 and stored.clear(spark) == 1 and stored.clear(spark) == 0


@pytest.mark.parametrize("constant", [False, True])
def test_no_task_takes_many_rows(spark, monkeypatch, constant):
    """Five million rows, in an order of their own or all of one value: ranges and parts hold at most 200,000 rows each."""
    seen, plain = {}, ranks.stored
    monkeypatch.setattr(ranks, "stored", lambda df, name: seen.setdefault(name, plain(df, name)))
    n = 5_000_000
    df = spark.range(n, numPartitions=8).select(F.lit("s").alias("series"), (F.lit(1.0) if constant else (F.col("id") * 7919 % n).cast("double")).alias("ord"), F.col("id").alias("x"))
    parts = ranks.Parts(df, ["series"], "ord", 3)
    assert not parts.single and seen["ranges"].groupBy("_range").count().agg(F.max("count")).first()[0] <= 200_000
    sizes = parts.rows.groupBy("_part").agg(F.count("*").alias("n"), F.count_if("_own").alias("own"))
    most, own = sizes.agg(F.max("n"), F.sum("own")).first()
    assert most <= 200_000 and own == n and parts.rows.where("_own").agg(F.count_distinct("_i"), F.max("_i")).first()[:] == (n, n - 1)
    if not constant:
        assert parts.rows.where("_i <> ord").isEmpty()


@pytest.mark.parametrize("kind", ["rising", "walk", "ties"])
def test_corners_hold_the_extremes_of_any_tilt(kind):
    import numpy as np

    rng = np.random.default_rng(3)
    s = {"rising": np.arange(500.0) ** 2, "walk": rng.normal(size=500).cumsum(), "ties": np.repeat(rng.integers(0, 3, 50), 10).astype(float)}[kind]
    at = metrics.corners(s)
    for m in (-1e3, -2.0, -0.1, 0.0, 0.3, 5.0, 998.0):
        tilted = s - m * np.arange(500)
        assert tilted[at].max() == tilted.max() and tilted[at].min() == tilted.min()
    assert kind != "walk" or len(at) < 100


@pytest.mark.parametrize("part", [7, 40, 10_000])
def test_hurst_by_parts_against_whole_segments(spark, monkeypatch, part):
    import numpy as np

    monkeypatch.setattr(ranks, "PART", part)
    monkeypatch.setattr(ranks, "WHOLE", 1 if part < 1000 else 10**6)
    rng = np.random.default_rng(7)
    series = {"walk": rng.normal(size=230).cumsum(), "flat": np.repeat([1.0, 2.0], 30), "short": np.arange(19.0), "rise": np.arange(150.0) ** 1.5}
    got = {r.series: r.hurst_exponent for r in metrics.hurst(spark.createDataFrame([(n, i, float(v)) for n, x in series.items() for i, v in enumerate(x)], "series string, ord int, x double")).collect()}
    for name, x in series.items():
        if len(x) < 20:
            assert name not in got
            continue
        points = []
        for size in metrics.window_lengths(len(x), 20):
            rs = []
            for k in range(len(x) // size):
                own = x[k * size : (k + 1) * size]
                run = (own - own.mean()).cumsum()
                if own.std() > 0:
                    rs.append((run.max() - run.min()) / own.std())
            if rs and np.mean(rs) > 0:
                points.append((np.log(size), np.log(np.mean(rs))))
        want = np.polyfit(*zip(*points), 1)[0] if len(points) >= 3 else None
        assert (got[name] is None) == (want is None) and (want is None or abs(got[name] - want) < 1e-9)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("part", [5, 100_000])
def test_state_at_events(spark, monkeypatch, part, strict):
    """Against a walk over all changes, with a key that has most rows, ties, nulls and repeated events."""
    import random

    from tidepanel.operators import asof

    monkeypatch.setattr(ranks, "PART", part)
    monkeypatch.setattr(ranks, "WHOLE", 0 if part == 5 else 200_000)
    rng = random.Random(11)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    changes = [(key(), rng.choice([*range(0, 60, 2), None]), rng.choice([None, i]), rng.choice([None, -i])) for i in range(1, 60)]
    events = [(key(), rng.choice([*range(60), None]), i % 50) for i in range(120)]
    got = asof.state_at(spark.createDataFrame(events, "asset string, t int, cap long"), spark.createDataFrame(changes, "asset string, t int, cap long, rate long"), ["asset"], ["t"], ["cap", "rate"], "state_", strict).collect()
    assert len(got) == len(events)

    def state(asset, t, at):
        own = [(c[1], c[at]) for c in changes if c[at] is not None and c[0] == asset and c[1] is not None and asset is not None and t is not None and (c[1] < t or c[1] == t and not strict)]
        best = max((x for x, _ in own), default=None)
        return {v for x, v in own if x == best} or {None}

    assert sorted(map(str, (tuple(r)[:3] for r in got))) == sorted(map(str, events))
    for r in got:
        assert r.state_cap in state(r.asset, r.t, 2) and r.state_rate in state(r.asset, r.t, 3)


@pytest.mark.parametrize("lg", [4, 7, 14])
def test_counts_of_full_sketches_are_exact(spark, lg):
    from tidepanel.operators import sketches

    df = spark.range(6000).select((F.lit(T0) + F.make_dt_interval(hours=(F.col("id") % 72).cast("int"))).alias("time"), F.expr("if(id % 5 = 0, null, id % 2)").alias("asset"), F.expr("if(id % 3 = 0, 'borrow', 'repay')").alias("kind"), F.expr("if(id % 7 = 0, null, id % 400)").alias("user"))
    users = sketches.members(df)
    made = sketches.sketched(users, time="time_bucket", lg=lg)
    sets = {}
    for r in df.where("user is not null").collect():
        for day in (r.time.date(), None):
            sets.setdefault((day, r.asset if day else None), {}).setdefault(r.kind, set()).add(r.user)
    got = sketches.counted_exactly(sketches.rolled(made, None, (), lg), users, None, (), lg)
    want = {}
    for (day, _), s in sets.items():
        for k, v in s.items() if day else ():
            want.setdefault(k, set()).update(v)
    assert {r.kind: r.n_users for r in got.collect()} == {k: len(v) for k, v in want.items()}
    rows = sketches.compared_exactly(sketches.rolled(made, "1 day", lg=lg), users, "borrow", "repay", "1 day", lg=lg).collect()
    assert {(r.time_bucket.date(), r.asset): tuple(r[2:]) for r in rows} == {
        k: (len(a), len(b), len(a & b), len(a | b), len(a - b)) for k, s in sets.items() if k[0] for a, b in [(s.get("borrow", set()), s.get("repay", set()))]
    }


def test_users_of_large_tables_are_those_of_the_sql(spark, tmp_path):
    """More users a day than a union of 2^12 hashes holds, and more in all than a sketch does."""
    import duckdb
    from tidepanel.plans.registry import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    events = "SELECT i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (i // 30000) DAY AS ts, i % 21000 AS user_id, CASE WHEN i % 5 < 2 THEN 'view' ELSE 'signup' END AS event_type, 0.5 AS value, '{\"k\": 17}' AS props FROM range(130000) t(i)"
    con.execute(f"copy ({events}) to '{tmp_path}/events.parquet'")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    for name in ("a06_users_by_day", "a06_users_of_all_time"):
        df = QUERIES[name](spark, str(tmp_path))
        assert {tuple(r) for r in df.collect()} == set(con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall())


def test_sketches_roll_up_without_events(spark):
    from tidepanel.operators import sketches

    n = 60_000
    df = spark.range(n).select((F.lit(T0) + F.make_dt_interval(hours=(F.col("id") % 96).cast("int"))).alias("time"), F.lit(1).alias("asset"), F.expr("if(id % 3 = 0, 'borrow', 'repay')").alias("kind"), F.expr("if(id % 3 = 0, id % 9000, id % 24000)").alias("user"))
    df = df.union(spark.createDataFrame([(T0, 1, "borrow", None)], df.schema))
    made = sketches.sketched(df, lg=12, lg_hll=12)
    exact = df.where("user is not null").groupBy("kind").agg(F.collect_set("user").alias("u")).collect()
    sets = {r.kind: set(r.u) for r in exact}
    month = sketches.rolled(made, "30 days", lg=12)
    for r in sketches.counted(month).groupBy("kind").agg(F.sum("n_users").alias("n"), F.sum("n_users_hll").alias("h")).collect():
        assert abs(r.n / len(sets[r.kind]) - 1) < 4 * 2**-6 and abs(r.h / len(sets[r.kind]) - 1) < 4 * 1.04 * 2**-6
    r = sketches.compared(month, "borrow", "repay").first()
    a, b = sets["borrow"], sets["repay"]
    error = 4 * 2**-6 * len(a | b)
    for got, want in ((r.n_a, a), (r.n_b, b), (r.n_both, a & b), (r.n_either, a | b), (r.n_only_a, a - b)):
        assert abs(got - len(want)) < error
    few = sketches.rolled(sketches.sketched(df.where("user < 1000"), lg=12), None, lg=12)
    assert {r.kind: r.n_users for r in sketches.counted(few).collect()} == {k: len([u for u in s if u < 1000]) for k, s in sets.items()}
    assert sketches.compared(sketches.rolled(made.where("kind = 'repay'"), "30 days", lg=12), "borrow", "repay").first()[2:] == (0, *[sketches.counted(sketches.rolled(made.where("kind = 'repay'"), "30 days", lg=12)).first().n_users][:1], 0, *[sketches.counted(sketches.rolled(made.where("kind = 'repay'"), "30 days", lg=12)).first().n_users][:1], 0)


def test_big_integers_with_a_sign(spark):
    import random

    from tidepanel.functions import bigint

    rng = random.Random(4)
    rows = [(g, rng.choice([-1, 1]) * rng.randrange(10 ** rng.choice([1, 18, 40, 89]))) for g in range(5) for _ in range(30)] + [(9, -5), (10, -5), (10, 5), (11, None)]
    df = spark.createDataFrame([(g, None if v is None else str(v)) for g, v in rows], "g int, x string").withColumn("x", bigint.parsed("x"))
    out = df.groupBy("g").agg(bigint.total("x").alias("t"), bigint.largest("x").alias("hi"), bigint.smallest("x").alias("lo"), bigint.signed_total("x", F.lit("7")).alias("net")).collect()
    for r in out:
        own = [v for g, v in rows if g == r.g and v is not None]
        assert (r.t, r.hi, r.lo) == ((str(sum(own)), str(max(own)), str(min(own))) if own else (None, None, None))
        assert r.net == str(sum(own) - 7 * len([1 for g, _ in rows if g == r.g]))
    with pytest.raises(Exception, match="more than 90 digits"):
        spark.createDataFrame([("-" + "9" * 91,)], "x string").agg(bigint.total("x")).collect()


def test_panels_of_negative_amounts(spark, tokens):
    supply = events(spark, [(T0, 5, 1, 1, 7, 0, 0.1, 1), (T0, 6, 2, 1, 8, 0, 0.2, 2)]).withColumn("amount", F.expr("if(user = 7, '-5', '12')"))
    withdraw = events(spark, [(T0, 7, 1, 1, 7, 0, None, None)]).withColumn("amount", F.lit("-40"))
    r = extract.supply_withdraw(supply, withdraw, tokens, exact=True).first()
    assert (r.supply_amount_raw, r.withdrawal_amount_raw, r.net_supply_flow_raw) == ("7", "-40", "47")


def test_parts_of_a_series_change_nothing(spark, monkeypatch):
    import random

    rng = random.Random(5)
    rows = [(s, i * 3, x if rng.random() > 0.05 else None) for s in "ab" for i in range(150) for x in [rng.uniform(-0.4, 0.5) if s == "a" else rng.uniform(1, 9)]]
    df = spark.createDataFrame(rows, "series string, ord long, x double")
    made = lambda: [
        metrics.returns(df), metrics.drawdowns(df), metrics.drawdowns(df, False), metrics.rolling_volatility(df, 6), metrics.rolling_volatility(df, 6, as_returns=False), metrics.autocorrelation(df, 3), metrics.hurst(df), metrics.drawdown_metrics(df), metrics.performance(df, as_returns=False),
    ]
    plain = lambda frames: [sorted(tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in f.fillna(-99.0).collect()) for f in frames]
    whole = plain(made())
    monkeypatch.setattr(ranks, "PART", 13)
    monkeypatch.setattr(ranks, "WHOLE", 20)
    assert plain(made()) == whole
    with pytest.raises(ValueError):
        metrics.rolling_volatility(df, 14)


def test_concentration_leaves_negative_values_out(spark):
    import numpy as np

    values = [-1.0, 1.0, 2.0, 3.0, 0.0, 5.0]
    r = metrics.shape(spark.createDataFrame([("s", i, x) for i, x in enumerate(values)], "series string, ord int, x double")).first()
    x = np.sort([v for v in values if v >= 0])
    n, total = len(x), x.sum()
    assert abs(r.gini_coefficient - (2 * (np.arange(1, n + 1) * x).sum() / (n * total) - (n + 1) / n)) < 1e-12
    assert abs(r.herfindahl_index - ((x / total) ** 2).sum()) < 1e-12 and abs(r.top_concentration - 5 / 11) < 1e-12
    p = x[x > 0] / x[x > 0].mean()
    assert abs(r.theil_index - (p * np.log(p)).mean()) < 1e-12


def test_one_value_is_not_enough(spark):
    one = spark.createDataFrame([("s", 0, 0.5)], "series string, ord int, x double")
    assert metrics.shape(one).first().semivariance is None
    d = metrics.drawdown_metrics(one).first()
    assert (d.max_drawdown, d.average_drawdown, d.ulcer_index) == (None, None, None)
    p = metrics.performance(one).first()
    assert (p.realized_volatility, p.sharpe_ratio, p.sortino_ratio, p.calmar_ratio) == (None, None, None, None)


def protocol_frame(spark, **bad):
    """A sound protocol series of six two-hour buckets, with some cells replaced: column={row: value}."""
    columns = {"time_bucket": [f"2024-01-01 {h:02d}:00:00.000 UTC" for h in range(0, 12, 2)]}
    for anchor, amounts, users in quality.FAMILIES.values():
        columns |= {anchor: [4.0] * 6, **{a: [300.0 if a.endswith("usd") else 0.1] * 6 for a in amounts}, **dict.fromkeys(users, [2.0] * 6)}
    columns |= {"avg_ltv": [5000.0] * 6, "avg_current_liquidation_threshold": [6000.0] * 6, "avg_total_collateral_base": [9.0] * 6, "avg_total_debt_base": [3.0] * 6, "avg_available_borrows_base": [1.0] * 6, "sampled_user_count": [3.0] * 6, "ordinal": [float(i) for i in range(6)]}
    for name, cells in bad.items():
        columns[name] = [cells.get(i, v) for i, v in enumerate(columns[name])]
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} {'string' if c == 'time_bucket' else 'double'}" for c in columns))


def whole(df):
    stamped = quality.tier0(df).collect()
    typed = df.withColumn("time_bucket", fc.parsed_time("time_bucket"))
    return {(r.tier, r.check, r.columns): r.n_fail for r in quality.whole_frame(typed, "2 hours", "ordinal").collect()}, {r.check: r.n_fail for r in stamped}


def test_sound_frame_passes(spark):
    found, stamped = whole(protocol_frame(spark))
    assert set(found.values()) == {0} and set(stamped.values()) == {0} and {t for t, *_ in found} == {"T0", "T1", "T2", "T3", "T4"}


@pytest.mark.parametrize(
    ("bad", "failing"),
    [
        ({"supply_tx_count": {1: 3.5}, "avg_ltv": {0: 0.5}, "sampled_user_count": {0: 0.0}, "ordinal": {3: 9.0}}, {"counts are whole", "basis points are not fractions", "at least two users sampled", "no mean without users", "buckets increase"}),
        ({"unique_suppliers": {2: None}, "avg_ltv": {0: 10_001.0}, "repay_amount_value_usd": {4: 400.0}}, {"counts are complete", "supply: count, amounts and users agree", "basis points in 0..10000", "avg_ltv <= avg_current_liquidation_threshold", "families imply one price"}),
        ({"supply_amount_value_usd": {3: -1.0}, "unique_borrowers": {1: 9.0}, "repay_amount_value_eth": {4: 0.0}, "avg_total_debt_base": {3: 3000.0, 4: 3000.0, 5: 3000.0}}, {"not negative", "no sentinel, no unscaled value", "supply: count, amounts and users agree", "unique_borrowers <= borrow_tx_count", "both denominations are there", "repay: count, amounts and users agree", "avg_total_debt_base <= avg_total_collateral_base", "level is stable"}),
        ({"supply_amount_value_usd": {3: 1e18}, "time_bucket": {3: "2024-01-01 04:00:00.000 UTC"}}, {"no sentinel, no unscaled value", "families imply one price", "bucket is unique", "no bucket is missing", "buckets increase"}),
        ({"borrow_tx_count": {1: 0.0}, "unique_borrowers": {1: 0.0}, "time_bucket": {3: "2024-01-01 06:30:00.000 UTC"}}, {"borrow: count, amounts and users agree", "bucket is on the grid", "no bucket is missing"}),
    ],
)
def test_broken_frame_fails_where_it_is_broken(spark, bad, failing):
    found, _ = whole(protocol_frame(spark, **bad))
    assert {c for (_, c, _), n in found.items() if n} == failing


def test_stamps_and_reserve_frame(spark):
    _, stamped = whole(protocol_frame(spark, time_bucket={2: "2024-01-01 04:00:00", 4: "soon UTC"}))
    assert stamped["bucket is a UTC timestamp"] == 2
    rows = [("2024-01-01 00:00:00.000 UTC", "a", 0.1, 1.0), ("2024-01-01 02:00:00.000 UTC", "a", -0.1, 0.9), ("2024-01-01 02:00:00.000 UTC", "a", 0.1, 1.2), ("2024-01-01 03:00:00", "b", None, None)]
    df = spark.createDataFrame(rows, "time_bucket string, asset string, liquidity_rate double, liquidity_index double")
    got = {(r.check, r.columns): r.n_fail for r in quality.reserve_frame(df, "2 hours").collect()}
    assert got["key is unique", "time_bucket,asset"] == 2 and got["bucket is a UTC timestamp", "time_bucket"] == 1 and got["bucket is on the grid", "time_bucket"] == 1
    assert got["at least 0", "liquidity_rate"] == 1 and got["at least 1", "liquidity_index"] == 1 and got["does not fall within an asset", "liquidity_index"] >= 1


def test_batch_and_export(spark, tmp_path):
    key = ["time_bucket", "asset"]
    make = lambda rows: spark.createDataFrame(rows, "time_bucket timestamp_ntz, asset string, asset_symbol string, enabled_count long, disabled_count long, unique_enable_users long, unique_disable_users long")
    good, bad = make([(T0, "a", "A", 2, 1, 1, 1)]), make([(T0, "a", "A", 2, 1, 1, 1), (T0, "a", "B", -1, 1, 9, 1)])
    results = [quality.validated(df, key, "2024-01-01", "2024-02-01", "2 hours", name) for name, df in (("good", good), ("bad", bad))]
    status = {r.table: (r.status, r.n_failing) for r in quality.batch(results).collect()}
    assert status["good"] == ("PASS", 0) and status["bad"][0] == "FAIL" and status["bad"][1] >= 4
    quality.exported(results[1], f"{tmp_path}/results")
    stored = spark.read.parquet(f"{tmp_path}/results").where("table = 'bad' and not success").collect()
    assert {"key is unique", "one symbol per asset", "not negative", "unique_enable_users <= enabled_count"} <= {r.check for r in stored}
    with pytest.raises(PySparkException):
        quality.exported(results[1], f"{tmp_path}/results")


def test_stored_panels_and_tables(spark, tmp_path):
    df = spark.range(3)
    panels.exported({"panel": df, "other": df}, str(tmp_path), "20240101T000000Z")
    panels.exported({"panel": df.limit(1)}, str(tmp_path), "20240201T000000Z")
    assert files.load_version(spark, str(tmp_path), "panel").count() == 1 and files.load_version(spark, str(tmp_path), "other").count() == 3
    with pytest.raises(KeyError):
        files.load_version(spark, str(tmp_path), "none")
    for name in ("flows_12_20240101T000000Z", "flows_12_20240301T000000Z", "prices_7_20240101T000000Z"):
        (tmp_path / f"{name}.csv").write_text("asset,n\n0xab,1\n")
    labels = {"12": "flows"}
    assert files.list_tables(spark, str(tmp_path), labels) == {"flows": "flows_12_20240301T000000Z.csv", "query_7": "prices_7_20240101T000000Z.csv"}
    got = files.load_all(spark, str(tmp_path), {"flows": "asset string, n int", "none": "x int"}, labels)
    assert set(got) == {"flows"} and got["flows"].count() == 1


def test_joins_of_the_transform_jobs_meet(spark, sf_dir):
    """The right side of each join gives values, so that equal results say something."""
    from tidepanel.plans.registry import QUERIES

    r = QUERIES["x03_reserve_panel"](spark, sf_dir).agg(F.count("last_borrow_rate").alias("a"), F.count("liquidity_rate").alias("b"), F.count("*").alias("n")).first()
    assert r.a > 0.2 * r.n and r.b > 0.2 * r.n
    r = QUERIES["x04_config_on_panel"](spark, sf_dir).agg(F.count("supply_cap_value_usd").alias("a"), F.count("*").alias("n")).first()
    assert r.a > 0.2 * r.n
    wide = QUERIES["x09_protocol_panel"](spark, sf_dir)
    assert len(wide.columns) == 45 and all(wide.agg(*(F.count(c).alias(c) for c in wide.columns)).first())
    for name, column in (("x05_liquidation_flows", "debt_covered_value_usd"), ("x07_flashloan_flows", "flashloan_premium_value_usd")):
        assert QUERIES[name](spark, sf_dir).agg(F.sum(column)).first()[0] > 0


def test_exact_scaling_of_any_type(spark):
    df = spark.createDataFrame([(1, str(2**200 + 1), 2**60 + 1, 2.5)], "asset long, a_raw string, b_raw long, c double")
    r = panels.scale_by_decimals(df, {"a_raw": 30, "b_raw": 18, "c": 1}).first()
    assert (r.a, r.b, r.c_scaled) == (float(f"{(2**200 + 1)}e-30"), float(f"{2**60 + 1}e-18"), 0.25)


def test_profile_flags(spark):
    rows = [(float(i), 5.0, str(2**256 - 1) if i < 2 else str(i), None if i % 2 else 0.0, "text") for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c string, d double, e string")
    out = {r.column: r for r in profile.profiled(df, list("abcde")).collect()}
    assert set(out) == set("abcd")
    assert out["b"].flags == "constant" and not out["b"].success and out["b"].mean is None
    assert out["c"].n_sentinel == 2 and out["c"].n_checked == 18 and "no_debt_sentinel" in out["c"].flags
    assert out["d"].flags == "high_null;zero_inflated;constant" and out["d"].null_pct == 50.0
    assert out["a"].skewness == 0.0 and round(out["a"].excess_kurtosis, 9) == -1.2


def test_checks_and_examples(spark):
    df = spark.createDataFrame([(h, n, v) for h, n, v in zip(hours(0, 2, 4, 4), (1, 0, 3, None), (5.0, 1.0, None, None))], "time_bucket timestamp_ntz, supply_tx_count long, unique_suppliers double")
    r = quality.run(df, [quality.at_most("unique_suppliers", "supply_tx_count")], "t", ("time_bucket",)).first()
    assert (r.n_checked, r.n_fail, r.success, r.examples) == (2, 2, False, ["2024-01-01 00:00:00", "2024-01-01 02:00:00"])
    many = spark.range(100).withColumn("x", -F.col("id"))
    r = quality.run(many, [quality.at_least("x")], key=("id",)).first()
    assert r.n_fail == 99 and len(r.examples) == 10
    assert quality.gaps(df, "2 hours").count() == 0 and quality.gaps(df.where("supply_tx_count <> 0 or supply_tx_count is null"), "1 hour").count() == 3


def test_zero_coupling_states(spark):
    cols = ["supply_tx_count", *quality.FAMILIES["supply"][1], *quality.FAMILIES["supply"][2]]
    df = spark.createDataFrame([(None, None, None, None), (0.0, 0.0, 0.0, 0.0), (1.0, 2.0, 3.0, 1.0), (0.0, 1.0, 0.0, 0.0), (2.0, None, 1.0, 1.0), (None, 1.0, 1.0, 1.0)], ", ".join(f"{c} double" for c in cols))
    check, states = quality.coupled(df, "supply")
    r = quality.run(df, [check]).first()
    assert (r.n_checked, r.n_fail) == (5, 3)
    assert df.select(*(F.count_if(F.coalesce(s, F.lit(False))).alias(n) for n, s in states.items())).first().asDict() == {"all_null": 1, "structural_zero": 1, "active": 2}


def test_latest_version_of_files(spark, tmp_path):
    for name, x in (("flows_12_20240101T000000Z", 1), ("flows_12_20240301T000000Z", 2), ("other_7_20240101T000000Z", 3), ("noise", 4)):
        (tmp_path / f"{name}.csv").write_text(f"asset,amount_raw\n0xab,{x}{'0' * 50}\n")
    labels = {"12": "flows"}
    schema = "asset string, amount_raw string"
    assert files.load(spark, str(tmp_path), "flows", schema, labels).first().amount_raw == "2" + "0" * 50
    assert files.load(spark, str(tmp_path), "query_7", schema, labels).count() == 1
    with pytest.raises(KeyError):
        files.load(spark, str(tmp_path), "none", schema, labels)


def test_versions_are_written_once(spark, tmp_path):
    df = spark.range(4).withColumn("day", F.col("id") % 2)
    to = panels.written_version(df, str(tmp_path), "panel", "20240101T000000Z", "day")
    assert spark.read.parquet(to).count() == 4
    with pytest.raises(PySparkException):
        panels.written_version(df, str(tmp_path), "panel", "20240101T000000Z")


def test_stream_matches_batch(spark, sf_dir, tmp_path):
    stream = buckets.event_stream(spark, sf_dir, "events.parquet")
    out = buckets.bucketed(stream, [F.sum("amount").alias("amount"), F.count("*").alias("n")])
    query = buckets.to_table(out, f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination(120)
    got = {(r.time_bucket, r.asset): (r.amount, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    own = ev.groupBy(fc.bucket(F.col("ts")).cast("timestamp").alias("b"), (F.regexp_extract("props", "([0-9]+)", 1).cast("long") % 10).alias("a")).agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("s"), F.count("*").alias("n"))
    batch = {(r.b, r.a): (r.s, r.n) for r in own.collect()}
    assert got and all(batch[k] == v for k, v in got.items())
    assert len(batch) - len(got) < 0.05 * len(batch)  # buckets within the watermark of the end are still open


def test_metamorphic(spark, sf_dir):
    from tidepanel.sources import roles

    ev = roles.events(spark, sf_dir, "supply")
    fine, coarse = (ev.groupBy(fc.bucket("time", w).alias("time_bucket")).agg(F.sum("amount").alias("x")) for w in ("2 hours", "6 hours"))
    again = fine.groupBy(fc.bucket("time_bucket", "6 hours").alias("time_bucket")).agg(F.sum("x").alias("x"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, coarse.collect()))
    shares = features.cross_asset(roles.reserve(spark, sf_dir)).groupBy("time_bucket").agg(F.sum("asset_share_of_updates").alias("s"))
    assert shares.where(F.abs(F.col("s") - 1) > 1e-9).isEmpty()


def test_all_components(spark, sf_dir):
    import numpy as np
    from tidepanel.plans.registry import QUERIES

    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().embedding
    ranked = np.argsort(np.argsort(np.stack(v), axis=0), axis=0)  # without ties
    for name, given in (("c01_correlation", np.stack(v).astype(float)), ("c01_spearman", ranked)):
        r = np.corrcoef(given.T)
        rows = {(x.col_a, x.col_b): x.r for x in QUERIES[name](spark, sf_dir).collect()}
        assert len(rows) == 64 * 63 // 2
        assert all(abs(r[int(a[1:]), int(b[1:])] - x) < (2e-6 if "corr" in name else 1e-3) for (a, b), x in rows.items())
    names = {f"e{i}" for i in range(64)}
    assert {x["column"] for x in QUERIES["c02_correlation_clusters"](spark, sf_dir).collect()} == names
    assert {x.series for x in QUERIES["r06_columns_by_tail_risk"](spark, sf_dir).collect()} == names
    assert sum(x.n for x in QUERIES["b05_group_means"](spark, sf_dir).collect()) == 64


def test_spearman_with_ties_and_missing_cells(spark):
    import pandas as pd

    rows = [(1.0, 5.0, 2.0), (1.0, 4.0, None), (3.0, 4.0, 9.0), (2.0, 1.0, 7.0), (5.0, 0.0, 7.0), (4.0, 4.0, 1.0)]
    for given in (rows, [x for x in rows if None not in x]):
        want = pd.DataFrame(given, columns=list("abc"), dtype=float)
        got = {(r.col_a, r.col_b): r.r for r in splits.correlation(spark.createDataFrame(given, "a double, b double, c double"), method="spearman").collect()}
        for (a, b), r in got.items():
            both = want[[a, b]].dropna().rank()
            assert abs(r - both[a].corr(both[b])) < 1e-12
        assert len(got) == 3


def test_whole_tables(spark, sf_dir):
    from tidepanel.plans.registry import QUERIES

    ev, customers = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("events", "customer"))
    assert QUERIES["e12_rolling_volatility"](spark, sf_dir).count() == ev.count() + customers.count()
    grid = QUERIES["s07_time_grid"](spark, sf_dir).collect()
    assert sum(r.n for r in grid) == ev.count() and len({r.time_bucket for r in grid}) == len(grid) > 300
    ends = ev.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    blocks = [r.block for r in QUERIES["p01_projection_filter"](spark, sf_dir).collect()]
    assert min(blocks) < ends.lo + 100 and max(blocks) > ends.hi - 100
