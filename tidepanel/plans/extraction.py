"""Queries over event and call tables: scans, set operations, aggregates, and the extraction panels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import bigint
from ..functions import columns as fc
from ..operators import asof, extract, sketches
from ..sources import roles
from ..sources.stored import stored
from .base import EVENTS, TOKENS, query, rounded


@query("""SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(round(value * 100)) AS BIGINT) AS cents FROM events
WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1""")
def s01_event_scan(spark, sf_dir):
    df = roles.between(roles.table(spark, sf_dir, "events"), "ts", "2024-01-03", "2024-01-20")
    return df.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))


@query("SELECT o_custkey % 10 AS asset, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def s02_call_scan(spark, sf_dir):
    return roles.successful(roles.calls(spark, sf_dir)).groupBy("asset").agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority AS param, count(*) AS n, max(o_orderdate) AS last FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1")
def s03_full_history_scan(spark, sf_dir):
    df = roles.between(roles.table(spark, sf_dir, "orders"), "o_orderdate", hi="1998-01-01")
    return df.groupBy(F.col("o_orderpriority").alias("param")).agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last"))


@query(f"WITH {TOKENS} SELECT asset, asset_symbol, decimals FROM tok")
def s04_token_dimension(spark, sf_dir):
    return roles.tokens(spark, sf_dir)


PRICES = """px AS (SELECT date_trunc('month', l_shipdate) AS time, p_brand AS asset,
  sum(CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT)) / CAST(count(*) AS DOUBLE) / 100 AS price FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


@query(f"WITH {PRICES} SELECT time, asset, round(price, 6) AS price FROM px WHERE time >= TIMESTAMP '1997-01-01' AND time < TIMESTAMP '1998-01-01'")
def s05_price_feed_scan(spark, sf_dir):
    return rounded(roles.between(roles.prices(spark, sf_dir), "time", "1997-01-01", "1998-01-01"))


@query("SELECT k.name, count(*) AS n FROM events JOIN (VALUES ('supply', 'purchase'), ('withdraw', 'click'), ('borrow', 'signup'), ('repay', 'view'), ('liquidation', 'error')) AS k(name, event_type) USING (event_type) GROUP BY 1")
def s06_inline_relation(spark, sf_dir):
    kinds = spark.createDataFrame(list(roles.KINDS.items()), "name string, event_type string")
    return roles.table(spark, sf_dir, "events").join(F.broadcast(kinds), "event_type").groupBy("name").agg(F.count("*").alias("n"))


@query(f"""WITH {EVENTS} SELECT g.time_bucket, count(block) AS n FROM (SELECT unnest(generate_series(min(time_bucket), max(time_bucket), INTERVAL '2 hours')) AS time_bucket FROM ev) g
LEFT JOIN ev USING (time_bucket) GROUP BY 1""")
def s07_time_grid(spark, sf_dir):
    """The grid from the first to the last bucket of the table."""
    ev = roles.events(spark, sf_dir).withColumn("time_bucket", fc.bucket("time"))
    ends = ev.agg(F.min("time_bucket").alias("lo"), F.max("time_bucket").alias("hi")).where("lo is not null")
    grid = ends.select(F.explode(F.expr("sequence(lo, hi, interval '2 hours')")).alias("time_bucket"))
    counts = ev.groupBy("time_bucket").agg(F.count("block").alias("n"))
    return grid.join(counts, "time_bucket", "left").select("time_bucket", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"""WITH {EVENTS} SELECT block, kind = 'purchase' AS is_supply, CASE WHEN kind = 'purchase' THEN amount END AS supplied, coalesce(CASE WHEN mode = 1 THEN amount END, 0) AS stable,
'event' AS tag, CAST(NULL AS BIGINT) AS debt FROM ev WHERE flag AND asset IN (SELECT p_partkey FROM part WHERE p_type <> 'ECONOMY')""")
def p01_projection_filter(spark, sf_dir):
    ev = roles.events(spark, sf_dir).where("flag").join(roles.tokens(spark, sf_dir), "asset", "left_semi")
    return ev.select("block", (F.col("kind") == "purchase").alias("is_supply"), F.when(F.col("kind") == "purchase", F.col("amount")).alias("supplied"), F.coalesce(F.when(F.col("mode") == 1, F.col("amount")), F.lit(0)).alias("stable"), F.lit("event").alias("tag"), F.lit(None).cast("long").alias("debt"))


@query("""SELECT c_custkey, regexp_matches(c_name, '^Customer#[0-9]{9}$') AS well_formed, TRY_CAST(right(c_name, 3) AS DOUBLE) AS tail, TRY_CAST(c_mktsegment AS DOUBLE) AS no_number,
strftime(TIMESTAMP '2024-01-01' + c_custkey * INTERVAL '1 minute', '%Y-%m-%d %H:%M:%S.000 UTC') AS stamp, lower(trim('  0xAB' || c_custkey || ' ')) AS address FROM customer""")
def p08_regex_coercion_keys(spark, sf_dir):
    time = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("c_custkey").cast("int"))
    return roles.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").rlike("^Customer#[0-9]{9}$").alias("well_formed"), F.right("c_name", F.lit(3)).try_cast("double").alias("tail"), F.col("c_mktsegment").try_cast("double").alias("no_number"),
        fc.canonical_time(time).alias("stamp"), fc.canonical_address(F.concat(F.lit("  0xAB"), "c_custkey", F.lit(" "))).alias("address"),
    )


@query("""SELECT o_orderkey, date_trunc('hour', t) AS hour_start, date_trunc('day', t) AS day_start, CAST(extract(hour FROM t) AS INTEGER) AS hour, time_bucket(INTERVAL '6 hours', t) AS six FROM (SELECT o_orderkey, o_orderdate + o_orderkey * INTERVAL '7 minutes' AS t FROM orders)""")
def f01_time_buckets(spark, sf_dir):
    t = roles.table(spark, sf_dir, "orders").withColumn("t", F.col("o_orderdate") + F.make_dt_interval(mins=F.col("o_orderkey").cast("int") * 7))
    return t.select("o_orderkey", F.date_trunc("hour", "t").cast("timestamp_ntz").alias("hour_start"), F.date_trunc("day", "t").cast("timestamp_ntz").alias("day_start"), F.hour("t").alias("hour"), fc.bucket("t", "6 hours").alias("six"))


@query("""SELECT l_orderkey % 50 AS asset, CAST(sum(CAST(round(l_extendedprice * 100) AS HUGEINT) * 1000000000000000000000) AS VARCHAR) AS total,
CAST(max(CAST(round(l_extendedprice * 100) AS HUGEINT) * 1000000000000000000000) AS VARCHAR) AS largest, CAST(min(CAST(round(l_extendedprice * 100) AS HUGEINT) * 1000000000000000000000) AS VARCHAR) AS smallest FROM lineitem GROUP BY 1""")
def f08_big_integers(spark, sf_dir):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").cast("string")
    x = bigint.parsed(F.concat(F.lit("00"), cents, F.lit("0" * 21)))
    return roles.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 50).alias("asset"), x.alias("x")).groupBy("asset").agg(bigint.total("x").alias("total"), bigint.largest("x").alias("largest"), bigint.smallest("x").alias("smallest"))


@query("""SELECT p_partkey, round(CAST(p_size AS DOUBLE) * 123456789 / 10 ** (p_size % 19), 6) AS scaled, CASE WHEN p_size < 15 THEN 'small' WHEN p_size < 35 THEN 'middle' ELSE 'large' END AS size_class,
round(100.0 * p_size / nullif(p_size % 7, 0), 4) AS pct, round(coalesce(log10(p_size), 0) + ln(p_size) + sqrt(p_size) + abs(-p_size) + floor(p_retailprice / 7) + ceil(p_retailprice / 7) + least(p_size, 20) + greatest(p_size, 20), 6) AS maths FROM part""")
def f05_scaling_cuts_math(spark, sf_dir):
    s, r = F.col("p_size"), F.col("p_retailprice") / 7
    maths = F.coalesce(F.log10("p_size"), F.lit(0.0)) + F.ln("p_size") + F.sqrt("p_size") + F.abs(-s) + F.floor(r) + F.ceil(r) + F.least(s, F.lit(20)) + F.greatest(s, F.lit(20))
    return roles.table(spark, sf_dir, "part").select(
        "p_partkey", F.round(fc.scaled(s.cast("long") * 123456789, F.pmod(s, F.lit(19))), 6).alias("scaled"), fc.cut_left_closed("p_size", (15, 35), ("small", "middle", "large")).alias("size_class"), fc.percent(s, s % 7).alias("pct"), F.round(maths, 6).alias("maths"),
    )


@query("""SELECT asset, kind, count(*) AS n FROM (SELECT l_partkey % 10 AS asset, 'collateral' AS kind FROM lineitem UNION ALL SELECT l_suppkey % 10, 'debt' FROM lineitem) GROUP BY 1, 2
UNION ALL SELECT asset, 'either', count(*) FROM (SELECT l_partkey AS asset FROM lineitem UNION SELECT l_suppkey FROM lineitem) GROUP BY 1, 2""")
def u01_unions(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem")
    legs = lines.select(F.explode(F.array(*(F.struct((F.col(k) % 10).alias("asset"), F.lit(n).alias("kind")) for k, n in (("l_partkey", "collateral"), ("l_suppkey", "debt"))))).alias("x"))
    by = legs.groupBy("x.asset", "x.kind").agg(F.count("*").alias("n"))
    either = lines.select(F.col("l_partkey").alias("asset")).union(lines.select("l_suppkey")).distinct()
    return by.unionByName(either.groupBy("asset").agg(F.count("*").alias("n")).withColumn("kind", F.lit("either")))


@query(f"""WITH {EVENTS} SELECT kind, block, amount FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY amount DESC, block) AS rn FROM ev) WHERE rn <= 10""")
def o03_top_examples(spark, sf_dir):
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("amount"), "block"))
    return rounded(roles.events(spark, sf_dir).withColumn("rn", rank).where("rn <= 10").select("kind", "block", "amount"))


@query("SELECT p_brand, p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def o05_sorted_preview(spark, sf_dir):
    return roles.table(spark, sf_dir, "part").orderBy(F.desc("p_retailprice"), "p_partkey").select("p_brand", "p_partkey", "p_retailprice").limit(25)


@query(f"""WITH {EVENTS}, {TOKENS}, a AS (SELECT time_bucket, asset, CAST(sum(CASE WHEN kind = 'purchase' THEN amount END) AS BIGINT) AS supply_amount_raw, CAST(sum(CASE WHEN kind = 'click' THEN amount END) AS BIGINT) AS withdrawal_amount_raw,
CAST(sum(CASE WHEN kind = 'purchase' THEN amount ELSE -amount END) AS BIGINT) AS net_supply_flow_raw, count(CASE WHEN kind = 'purchase' THEN 1 END) AS supply_tx_count, count(CASE WHEN kind = 'click' THEN 1 END) AS withdrawal_tx_count,
count(DISTINCT CASE WHEN kind = 'purchase' THEN usr END) AS unique_suppliers, count(DISTINCT CASE WHEN kind = 'click' THEN usr END) AS unique_withdraw_users,
max(CASE WHEN kind = 'purchase' THEN block END) AS latest_supply_block, max(CASE WHEN kind = 'click' THEN block END) AS latest_withdraw_block FROM ev WHERE kind IN ('purchase', 'click') GROUP BY 1, 2)
SELECT a.*, asset_symbol FROM a LEFT JOIN tok USING (asset)""")
def q01_supply_withdraw(spark, sf_dir):
    return rounded(extract.supply_withdraw(roles.events(spark, sf_dir, "supply"), roles.events(spark, sf_dir, "withdraw"), roles.tokens(spark, sf_dir), exact=True))


@query(f"""WITH {EVENTS}, {TOKENS}, a AS (SELECT time_bucket, asset, CAST(sum(CASE WHEN kind = 'signup' THEN amount END) AS BIGINT) AS borrow_amount_raw, CAST(sum(CASE WHEN kind = 'view' THEN amount END) AS BIGINT) AS repay_amount_raw,
CAST(sum(CASE WHEN kind = 'signup' THEN amount ELSE -amount END) AS BIGINT) AS net_debt_flow_raw, count(CASE WHEN kind = 'signup' THEN 1 END) AS borrow_tx_count, count(CASE WHEN kind = 'view' THEN 1 END) AS repay_tx_count,
count(CASE WHEN kind = 'signup' AND mode = 1 THEN 1 END) AS stable_borrow_count, count(CASE WHEN kind = 'signup' AND mode = 2 THEN 1 END) AS variable_borrow_count,
count(DISTINCT CASE WHEN kind = 'signup' THEN usr END) AS unique_borrowers, count(DISTINCT CASE WHEN kind = 'view' THEN usr END) AS unique_repayers,
arg_max(rate, CASE WHEN kind = 'signup' THEN block END) AS last_borrow_rate, max(CASE WHEN kind = 'signup' THEN block END) AS latest_borrow_block, max(CASE WHEN kind = 'view' THEN block END) AS latest_repay_block
FROM ev WHERE kind IN ('signup', 'view') GROUP BY 1, 2) SELECT a.*, asset_symbol FROM a LEFT JOIN tok USING (asset)""")
def q02_borrow_repay(spark, sf_dir):
    return rounded(extract.borrow_repay(roles.events(spark, sf_dir, "borrow"), roles.events(spark, sf_dir, "repay"), roles.tokens(spark, sf_dir), exact=True))


@query(f"""WITH {EVENTS}, b AS (SELECT * FROM ev WHERE kind = 'signup'), c AS (SELECT asset, block, mode, amount FROM ev WHERE kind = 'error')
SELECT b.block, b.asset, b.amount, s0.amount AS supply_cap, s1.amount AS borrow_cap, s2.amount AS debt_ceiling FROM b """ + " ".join(f"ASOF LEFT JOIN (SELECT * FROM c WHERE mode = {m}) s{m} ON b.asset = s{m}.asset AND b.block >= s{m}.block" for m in range(3)))
def j03_state_at_event(spark, sf_dir):
    """The caps in force at each borrowing."""
    changes = roles.cap_changes(spark, sf_dir)
    wide = changes.select("asset", "block", *(F.when(F.col("param") == p, F.col("value")).alias(p) for p in roles.PARAMETERS))
    borrowed = roles.events(spark, sf_dir, "borrow").select("block", "asset", "amount")
    return asof.state_at(borrowed, wide, ["asset"], ["block"], roles.PARAMETERS)


def _users(spark, sf_dir):
    """Each user once per two hours, asset and kind of event, and sketches of these."""
    users = stored(sketches.members(roles.events(spark, sf_dir)), "members")
    return users, stored(sketches.sketched(users, time="time_bucket"), "sketches")


@query(f"""WITH {EVENTS}, u AS (SELECT DISTINCT time_bucket(INTERVAL '1 day', time_bucket) AS time_bucket, asset, kind, usr FROM ev WHERE kind IN ('signup', 'view')),
x AS (SELECT time_bucket, asset, usr, bool_or(kind = 'signup') AS a, bool_or(kind = 'view') AS b FROM u GROUP BY 1, 2, 3)
SELECT time_bucket, asset, count(CASE WHEN a THEN 1 END) AS n_a, count(CASE WHEN b THEN 1 END) AS n_b, count(CASE WHEN a AND b THEN 1 END) AS n_both, count(*) AS n_either, count(CASE WHEN a AND NOT b THEN 1 END) AS n_only_a FROM x GROUP BY 1, 2""")
def a06_users_by_day(spark, sf_dir):
    """Who borrowed, who repaid and who did both on each day, from stored sketches of two hours; days and assets with more users than a sketch holds hashes are counted from stored members."""
    users, made = _users(spark, sf_dir)
    return sketches.compared_exactly(sketches.rolled(made, "1 day"), users, "signup", "view", "1 day")


@query(f"""WITH {EVENTS} SELECT kind, count(DISTINCT usr) AS n_users FROM ev GROUP BY 1""")
def a06_users_of_all_time(spark, sf_dir):
    users, made = _users(spark, sf_dir)
    return sketches.counted_exactly(sketches.rolled(made, None, ()), users, None, ())


@query()
def a06_approximate_distinct(spark, sf_dir):
    return rounded(extract.borrow_repay(roles.events(spark, sf_dir, "borrow"), roles.events(spark, sf_dir, "repay"), roles.tokens(spark, sf_dir)))


FIELDS = ("liquidity_rate", "variable_borrow_rate", "stable_borrow_rate", "liquidity_index", "variable_borrow_index")


@query("""WITH s AS (SELECT time_bucket(INTERVAL '1 day', l_shipdate) AS time_bucket, l_partkey % 10 AS asset, *, row_number() OVER (PARTITION BY l_partkey % 10, time_bucket(INTERVAL '1 day', l_shipdate) ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC) AS rn,
count(*) OVER (PARTITION BY l_partkey % 10, time_bucket(INTERVAL '1 day', l_shipdate)) AS n FROM lineitem)
SELECT time_bucket, asset, round(l_discount / 100.0, 6) AS liquidity_rate, round(l_tax / 100.0, 6) AS variable_borrow_rate, round(l_quantity / 100.0, 6) AS stable_borrow_rate, round(l_extendedprice / 100.0, 6) AS liquidity_index, round(l_linenumber / 100.0, 6) AS variable_borrow_index, n AS update_count FROM s WHERE rn = 1""")
def q03_reserve_state(spark, sf_dir):
    return rounded(extract.reserve_state(roles.states(spark, sf_dir), FIELDS, "1 day", 100.0))


PARAMS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(f"""WITH {TOKENS}, ch AS (SELECT o_orderdate AS t, o_orderkey AS block, CAST(c_nationkey AS BIGINT) AS asset, o_orderpriority AS param, CAST(round(o_totalprice * 100) AS BIGINT) AS value FROM orders JOIN customer ON o_custkey = c_custkey),
l AS (SELECT date_trunc('day', t) AS b, asset, param, arg_max(value, block) AS value FROM ch GROUP BY 1, 2, 3),
iv AS (SELECT *, lead(b) OVER (PARTITION BY asset, param ORDER BY b) AS e FROM l),
g AS (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1996-03-31', INTERVAL '1 day')) AS time_bucket),
s AS (SELECT time_bucket, asset, {", ".join(f"coalesce(max(CASE WHEN param = '{p}' THEN value END), 0) AS \"{p}\"" for p in PARAMS)} FROM g JOIN iv ON time_bucket >= b AND (e IS NULL OR time_bucket < e) GROUP BY 1, 2),
n AS (SELECT date_trunc('day', t) AS time_bucket, asset, count(*) AS k FROM ch GROUP BY 1, 2)
SELECT s.*, coalesce(k, 0) AS config_event_count, asset_symbol FROM s LEFT JOIN n USING (time_bucket, asset) LEFT JOIN tok USING (asset)""")
def q04_reserve_config(spark, sf_dir):
    return extract.reserve_config(roles.config_changes(spark, sf_dir), roles.tokens(spark, sf_dir), PARAMS, "1996-01-01", "1996-03-31", "1 day")


_LEGS = """a AS (SELECT time_bucket, asset, {sums}, count(CASE WHEN leg = 'c' THEN 1 END) AS collateral_tx_count, count(CASE WHEN leg = 'd' THEN 1 END) AS debt_tx_count, count(*) AS liquidation_tx_count,
count(CASE WHEN leg = 'c' AND r THEN 1 END) AS receive_token_count, count(DISTINCT usr) AS unique_liquidated_users, count(DISTINCT liq) AS unique_liquidators, max(block) AS latest_liquidation_block FROM leg GROUP BY 1, 2)"""
_LEG_SUMS = "CAST(coalesce(sum(CASE WHEN leg = 'c' THEN amount END), 0) AS BIGINT) AS collateral_amount_raw, CAST(coalesce(sum(CASE WHEN leg = 'd' THEN amount END), 0) AS BIGINT) AS debt_covered_raw"


@query(f"""WITH {TOKENS}, leg AS (SELECT date_trunc('day', l_shipdate) AS time_bucket, 'c' AS leg, l_partkey % 10 AS asset, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount, l_orderkey AS usr, l_suppkey AS liq, l_returnflag = 'R' AS r, l_orderkey AS block FROM lineitem
UNION ALL SELECT date_trunc('day', l_shipdate), 'd', l_suppkey % 10, CAST(round(l_extendedprice * l_discount * 100) AS BIGINT), l_orderkey, l_suppkey, l_returnflag = 'R', l_orderkey FROM lineitem),
{_LEGS.format(sums=_LEG_SUMS)} SELECT a.*, asset_symbol FROM a LEFT JOIN tok USING (asset)""")
def q05_liquidation(spark, sf_dir):
    return rounded(extract.liquidation(roles.legs(spark, sf_dir), roles.tokens(spark, sf_dir), "1 day", exact=True))


_FLASH = """a AS (SELECT time_bucket, asset, CAST(sum(amount) AS BIGINT) AS amount, CAST(sum(amount // 1000) AS BIGINT) AS premium, count(*) AS flashloan_tx_count, count(DISTINCT usr) AS unique_initiators,
count(CASE WHEN mode = 0 THEN 1 END) AS mode0_count, count(CASE WHEN mode = 1 THEN 1 END) AS mode1_count, count(CASE WHEN mode = 2 THEN 1 END) AS mode2_count, max(block) AS latest_block FROM ev WHERE kind = 'click' GROUP BY 1, 2)"""


def _loans(spark, sf_dir):
    return roles.events(spark, sf_dir, "withdraw").withColumn("premium", F.expr("amount div 1000"))


@query(f"WITH {EVENTS}, {TOKENS}, {_FLASH} SELECT a.* EXCLUDE (amount, premium), amount AS flashloan_amount_raw, premium AS flashloan_premium_raw, asset_symbol FROM a LEFT JOIN tok USING (asset)")
def q06_flashloan(spark, sf_dir):
    return rounded(extract.flashloan(_loans(spark, sf_dir), roles.tokens(spark, sf_dir), exact=True))


@query(f"WITH {EVENTS}, {TOKENS}, {_FLASH} SELECT a.* EXCLUDE (amount, premium), round(CAST(amount AS DOUBLE) / pow(10.0, decimals), 6) AS flashloan_amount, round(CAST(premium AS DOUBLE) / pow(10.0, decimals), 6) AS flashloan_premium, asset_symbol FROM a LEFT JOIN tok USING (asset)")
def q01b_flashloan_scaled(spark, sf_dir):
    return rounded(extract.flashloan(_loans(spark, sf_dir), roles.tokens(spark, sf_dir), exact=True, scale=True))


@query(f"""WITH {TOKENS}, a AS (SELECT date_trunc('hour', o_orderdate) AS time_bucket, o_custkey % 10 AS asset, arg_max(CAST(round(o_totalprice * 100) AS BIGINT), o_orderkey) AS last_price, max(o_orderkey) AS latest_block, count(*) AS call_count FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2)
SELECT a.*, asset_symbol FROM a LEFT JOIN tok USING (asset)""")
def q07_last_price(spark, sf_dir):
    return extract.last_price(roles.successful(roles.calls(spark, sf_dir)), roles.tokens(spark, sf_dir))


@query("""SELECT date_trunc('day', o_orderdate) AS time_bucket, round(sum(CAST(round(o_totalprice * 100) AS BIGINT)) / CAST(count(*) AS DOUBLE), 4) AS avg_output, CAST(min(round(o_totalprice * 100)) AS BIGINT) AS min_health_factor, CAST(max(round(o_totalprice * 100)) AS BIGINT) AS max_health_factor,
count(DISTINCT o_custkey) AS sampled_users, count(*) AS call_count FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def q08_user_account(spark, sf_dir):
    return rounded(extract.user_account(roles.successful(roles.calls(spark, sf_dir)), ["output"], "output", "1 day", exact=True), 4)


@query(f"""WITH {EVENTS}, {TOKENS}, a AS (SELECT time_bucket, asset, count(CASE WHEN kind = 'view' THEN 1 END) AS enabled_count, count(CASE WHEN kind = 'signup' THEN 1 END) AS disabled_count,
count(DISTINCT CASE WHEN kind = 'view' THEN usr END) AS unique_enable_users, count(DISTINCT CASE WHEN kind = 'signup' THEN usr END) AS unique_disable_users, max(block) AS latest_block FROM ev WHERE kind IN ('view', 'signup') GROUP BY 1, 2)
SELECT a.*, asset_symbol FROM a LEFT JOIN tok USING (asset)""")
def q09_collateral_toggle(spark, sf_dir):
    return extract.collateral_toggle(roles.events(spark, sf_dir, "repay"), roles.events(spark, sf_dir, "borrow"), roles.tokens(spark, sf_dir), exact=True)


@query(f"""WITH {PRICES}, eth AS (SELECT time, price AS base FROM px WHERE asset = 'Brand#1'), own AS (SELECT px.* FROM px WHERE asset IN (SELECT DISTINCT p_brand FROM part WHERE p_size > 48))
SELECT time_bucket(INTERVAL '1 day', time) AS time_bucket, asset, round(avg(price), 9) AS avg_price_usd, round(avg(price / base), 9) AS avg_price_eth, count(price) AS price_points, any_value(n) AS n_parts
FROM own JOIN eth USING (time) LEFT JOIN (SELECT p_brand AS asset, count(*) AS n FROM part GROUP BY 1) USING (asset) GROUP BY 1, 2""")
def q10_two_denominations(spark, sf_dir):
    parts = roles.table(spark, sf_dir, "part")
    universe = parts.where("p_size > 48").select(F.col("p_brand").alias("asset"))
    dims = parts.groupBy(F.col("p_brand").alias("asset")).agg(F.count("*").alias("n_parts"))
    return rounded(extract.two_denominations(roles.prices(spark, sf_dir), universe, "Brand#1", "1 day", dims), 9)


#: Amounts of roles.wide_events are cents * 10^36 + block; sums of both parts are put together as digits here.
_BASE = "CAST('1000000000000000000000000000000000000' AS HUGEINT)"


def _wide_sum(high: str, low: str) -> str:
    """SQL of the digits of high * 10^36 + low, for 0 <= low < 10^36; null if both are."""
    return f"ltrim(CAST({high} AS VARCHAR) || lpad(CAST({low} AS VARCHAR), 36, '0'), '0')"


def _wide_net(high: str, low: str) -> str:
    """The same for parts of any sign with |low| < 10^36."""
    up = f"(CASE WHEN {low} < 0 THEN {_wide_sum(f'({high} - 1)', f'({low} + {_BASE})')} ELSE {_wide_sum(high, low)} END)"
    down = f"(CASE WHEN {low} > 0 THEN {_wide_sum(f'(-({high}) - 1)', f'({_BASE} - {low})')} ELSE {_wide_sum(f'(-({high}))', f'(-({low}))')} END)"
    return f"CASE WHEN {high} > 0 OR {high} = 0 AND {low} > 0 THEN {up} WHEN {high} = 0 AND {low} = 0 THEN '0' ELSE '-' || {down} END"


def _wide_two(kinds: tuple[str, str], names: tuple[str, str, str]) -> str:
    """SQL of the amounts of two kinds of wide events and of their difference, by bucket and asset."""
    a, b = (f"kind = '{k}'" for k in kinds)
    parts = ", ".join(f"sum(CASE WHEN {cond} THEN {x} END)::HUGEINT AS {x[0]}{i}" for i, cond in enumerate((a, b)) for x in ("amount", "block"))
    return f"""WITH {EVENTS}, t AS (SELECT time_bucket, asset, {parts} FROM ev WHERE {a} OR {b} GROUP BY 1, 2), d AS (SELECT *, coalesce(a0, 0) - coalesce(a1, 0) AS hi, coalesce(b0, 0) - coalesce(b1, 0) AS lo FROM t)
SELECT time_bucket, asset, {_wide_sum('a0', 'b0')} AS {names[0]}, {_wide_sum('a1', 'b1')} AS {names[1]}, {_wide_net('hi', 'lo')} AS {names[2]} FROM d"""


@query(_wide_two(("purchase", "click"), ("supply_amount_raw", "withdrawal_amount_raw", "net_supply_flow_raw")))
def q01_supply_withdraw_wide(spark, sf_dir):
    """256-bit amounts in digit strings: totals of more than 38 digits, exact and signed."""
    out = extract.supply_withdraw(roles.wide_events(spark, sf_dir, "supply"), roles.wide_events(spark, sf_dir, "withdraw"), roles.tokens(spark, sf_dir))
    return out.select("time_bucket", "asset", "supply_amount_raw", "withdrawal_amount_raw", "net_supply_flow_raw")


@query(_wide_two(("signup", "view"), ("borrow_amount_raw", "repay_amount_raw", "net_debt_flow_raw")))
def q02_borrow_repay_wide(spark, sf_dir):
    """The same for debt, summed by user first."""
    out = extract.borrow_repay(roles.wide_events(spark, sf_dir, "borrow"), roles.wide_events(spark, sf_dir, "repay"), roles.tokens(spark, sf_dir), exact=True)
    return out.select("time_bucket", "asset", "borrow_amount_raw", "repay_amount_raw", "net_debt_flow_raw")


@query(f"""WITH {EVENTS}, leg AS (SELECT time_bucket, asset, 'c' AS leg, amount, block FROM ev WHERE kind = 'error' UNION ALL SELECT time_bucket, (asset + mode) % 10, 'd', amount, block FROM ev WHERE kind = 'error'),
t AS (SELECT time_bucket, asset, sum(CASE WHEN leg = 'c' THEN amount END)::HUGEINT AS a0, sum(CASE WHEN leg = 'c' THEN block END)::HUGEINT AS b0, sum(CASE WHEN leg = 'd' THEN amount END)::HUGEINT AS a1, sum(CASE WHEN leg = 'd' THEN block END)::HUGEINT AS b1 FROM leg GROUP BY 1, 2)
SELECT time_bucket, asset, coalesce({_wide_sum('a0', 'b0')}, '0') AS collateral_amount_raw, coalesce({_wide_sum('a1', 'b1')}, '0') AS debt_covered_raw FROM t""")
def q05_liquidation_wide(spark, sf_dir):
    wide = roles.wide_events(spark, sf_dir, "liquidation").select("block", F.col("amount").alias("collateral_amount"), F.col("amount").alias("debt_amount"))
    rows = roles.event_legs(spark, sf_dir).drop("collateral_amount", "debt_amount").join(wide, "block")
    return extract.liquidation(rows, roles.tokens(spark, sf_dir)).select("time_bucket", "asset", "collateral_amount_raw", "debt_covered_raw")


@query(f"""WITH {EVENTS}, t AS (SELECT time_bucket, asset, sum(amount)::HUGEINT AS a0, sum(block)::HUGEINT AS b0, count(*) AS n FROM ev WHERE kind = 'click' GROUP BY 1, 2)
SELECT time_bucket, asset, {_wide_sum('a0', 'b0')} AS flashloan_amount_raw, {_wide_sum('2 * a0', '2 * b0')} AS flashloan_premium_raw, n AS flashloan_tx_count FROM t""")
def q06_flashloan_wide(spark, sf_dir):
    loans = roles.wide_events(spark, sf_dir, "withdraw").withColumn("premium", F.col("amount"))
    loans = loans.withColumn("premium", bigint.parsed(F.concat(F.lit("0"), F.col("premium"))))
    both = extract.flashloan(loans, roles.tokens(spark, sf_dir), exact=True)
    twice = extract.flashloan(loans.union(loans), roles.tokens(spark, sf_dir), exact=True).select("time_bucket", "asset", "flashloan_premium_raw")
    return both.drop("flashloan_premium_raw").join(twice, ["time_bucket", "asset"]).select("time_bucket", "asset", "flashloan_amount_raw", "flashloan_premium_raw", "flashloan_tx_count")


@query("""WITH c AS (SELECT date_trunc('day', o_orderdate) AS time_bucket, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderkey AS block FROM orders WHERE o_orderstatus <> 'P'), m AS (SELECT time_bucket, min((cents, block)) AS lo, max((cents, block)) AS hi, count(*) AS call_count FROM c GROUP BY 1)
SELECT time_bucket, CAST(lo[1] AS VARCHAR) || lpad(CAST(lo[2] AS VARCHAR), 36, '0') AS min_health_factor, CAST(hi[1] AS VARCHAR) || lpad(CAST(hi[2] AS VARCHAR), 36, '0') AS max_health_factor, call_count FROM m""")
def q08_user_account_wide(spark, sf_dir):
    """Health factors in digit strings of different lengths, ordered as numbers."""
    calls = roles.successful(roles.calls(spark, sf_dir)).withColumn("output", F.concat(F.col("output").cast("string"), F.lpad(F.col("block").cast("string"), 36, "0")))
    return extract.user_account(calls, [], "output", "1 day", exact=True).select("time_bucket", "min_health_factor", "max_health_factor", "call_count")


#: (metric, decimals, unit) that are the same for all assets, by panel: fixed values.
COUNT, BLOCK = (0, "count"), (0, "block_number")
FIXED = {
    "d01": [(m, *COUNT) for m in ("supply_tx_count", "withdrawal_tx_count", "unique_suppliers", "unique_withdraw_users")] + [(m, *BLOCK) for m in ("latest_supply_block", "latest_withdraw_block")],
    "d02": [(m, *COUNT) for m in ("borrow_tx_count", "repay_tx_count", "stable_borrow_count", "variable_borrow_count", "unique_borrowers", "unique_repayers")] + [("last_borrow_rate", 27, "ray")] + [(m, *BLOCK) for m in ("latest_borrow_block", "latest_repay_block")],
    "d03": [(m, 27, "ray") for m in ("liquidity_rate", "variable_borrow_rate", "stable_borrow_rate", "liquidity_index", "variable_borrow_index")] + [("update_count", *COUNT)],
    "d04": [("supply_cap", 0, "whole_tokens"), ("borrow_cap", 0, "whole_tokens"), ("debt_ceiling", 2, "usd_2dp")] + [(m, 4, "bps") for m in ("ltv", "liquidation_threshold", "liquidation_bonus", "reserve_factor")]
    + [(m, *COUNT) for m in ("config_event_count", "collateral_tx_count", "debt_tx_count", "receive_token_count", "unique_liquidated_users", "unique_liquidators")],
    "d05": [(m, *COUNT) for m in ("flashloan_tx_count", "unique_initiators", "mode0_count", "mode1_count", "mode2_count", "call_count")] + [("latest_block", *BLOCK), ("oracle_asset_price", 8, "usd_8dp")],
    "d06": [(m, 8, "usd_8dp") for m in ("avg_total_collateral_base", "avg_total_debt_base", "avg_available_borrows_base")] + [(m, 4, "bps") for m in ("avg_ltv", "avg_current_liquidation_threshold")] + [(m, 18, "wad") for m in ("min_health_factor", "max_health_factor")] + [(m, *COUNT) for m in ("sampled_users", "call_count")],
    "d07": [(m, *COUNT) for m in ("enabled_count", "disabled_count", "unique_enable_users", "unique_disable_users")] + [("latest_block", *BLOCK)],
}
#: The asset-dependent metrics and the events whose assets count.
SEEN = {
    "d01": (("supply", "withdraw"), ("supply_amount_raw", "withdrawal_amount_raw", "net_supply_flow_raw")),
    "d02": (("borrow", "repay"), ("borrow_amount_raw", "repay_amount_raw", "net_debt_flow_raw")),
    "d04": (("liquidation",), ("collateral_amount_raw", "debt_covered_raw")),
    "d05": (("withdraw",), ("flashloan_amount_raw", "flashloan_premium_raw")),
}


def _dictionary(key: str):
    kinds, metrics = SEEN[key]
    values = ", ".join(f"('{m}', {d}, '{u}')" for m, d, u in FIXED[key])
    sql = f"SELECT CAST(NULL AS BIGINT) AS asset, CAST(NULL AS VARCHAR) AS asset_symbol, m AS metric, d AS decimals, u AS unit FROM (VALUES {values}) AS f(m, d, u)"
    names = ", ".join(f"('{m}')" for m in metrics)
    where = ", ".join(f"'{roles.KINDS[k]}'" for k in kinds)
    sql = f"WITH {EVENTS}, {TOKENS} {sql} UNION ALL SELECT asset, asset_symbol, m, decimals, 'raw_token_amount' FROM (SELECT DISTINCT asset FROM ev WHERE kind IN ({where})) CROSS JOIN (VALUES {names}) AS n(m) LEFT JOIN tok USING (asset)"

    def run(spark, sf_dir):
        seen = [roles.events(spark, sf_dir, k) for k in kinds]
        return extract.metric_dictionary(spark, FIXED[key], seen, metrics, roles.tokens(spark, sf_dir)).orderBy("metric", F.asc_nulls_last("asset"))

    run.__name__ = f"{key}_metric_dictionary"
    query(sql)(run)


for _key in SEEN:
    _dictionary(_key)


def _covered(key: str, panel, sql: str, renamed: dict[str, str]):
    """A dictionary of fixed metrics next to how many values its panel has of each; sql: the number of the panel's rows."""
    values = ", ".join(f"('{m}', {d}, '{u}', {str(m in renamed.values()).lower()})" for m, d, u in FIXED[key])
    text = f"WITH {sql} SELECT CAST(NULL AS BIGINT) AS asset, CAST(NULL AS VARCHAR) AS asset_symbol, m AS metric, d AS decimals, u AS unit, CASE WHEN there THEN n END AS n_values FROM (VALUES {values}) AS f(m, d, u, there), (SELECT count(*) AS n FROM x)"

    def run(spark, sf_dir):
        own = panel(spark, sf_dir)
        own = own.select(*(F.col(a).alias(b) for a, b in renamed.items()))
        return extract.covered(extract.metric_dictionary(spark, FIXED[key]), own)

    run.__name__ = f"{key}_metric_dictionary"
    query(text)(run)


_covered("d03", lambda spark, sf_dir: extract.reserve_state(roles.states(spark, sf_dir), FIELDS, "1 day", 100.0), "x AS (SELECT DISTINCT l_partkey % 10, date_trunc('day', l_shipdate) FROM lineitem)", {f: f for f in (*FIELDS, "update_count")})
_covered(
    "d06", lambda spark, sf_dir: extract.user_account(roles.successful(roles.calls(spark, sf_dir)), ["output"], "output", "1 day"), "x AS (SELECT DISTINCT date_trunc('day', o_orderdate) FROM orders WHERE o_orderstatus <> 'P')",
    {"avg_output": "avg_total_collateral_base", "min_health_factor": "min_health_factor", "max_health_factor": "max_health_factor", "sampled_users": "sampled_users", "call_count": "call_count"},
)
_covered(
    "d07", lambda spark, sf_dir: extract.collateral_toggle(roles.events(spark, sf_dir, "repay"), roles.events(spark, sf_dir, "borrow"), roles.tokens(spark, sf_dir)), f"{EVENTS}, x AS (SELECT DISTINCT time_bucket, asset FROM ev WHERE kind IN ('view', 'signup'))",
    {n: n for n in ("enabled_count", "disabled_count", "unique_enable_users", "unique_disable_users", "latest_block")},
)
