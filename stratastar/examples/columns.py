"""Projections, cleaning, keys, filters and business formulas on the given tables.

Texts as a source would send them come from expressions that both engines read alike.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stratastar import functions as fn
from stratastar.examples.registry import Tables, query
from stratastar.operators import Check, latest_version, quality_log, with_unknown
from stratastar.sources.bronze import as_source, conform, write_summary

CUSTOMER_CONTRACT = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("s8_contract", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t: Tables):
    return conform(t.customer.select(*reversed(CUSTOMER_CONTRACT)), CUSTOMER_CONTRACT, "customer")


@query(
    "s11_stringify",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
              CAST(user_id AS VARCHAR) AS user_id, event_type, printf('%.2f', value) AS value, props,
              CASE WHEN value > 50 THEN '1' WHEN value <= 50 THEN '0' END AS large,
              CAST(CAST(ts AS DATE) AS VARCHAR) AS day
       FROM events""",
)
def _(t: Tables):
    batch = t.events.withColumns({"large": F.col("value") > 50, "day": F.col("ts").cast("date")})
    return as_source(batch, batch.columns, "events")


@query(
    "s12_write_summary",
    """SELECT 'conversations' AS table_cible, count(*) AS nb_versions, count(DISTINCT conv_id) AS nb_cles FROM conversations
       UNION ALL SELECT 'events', count(*), count(DISTINCT user_id) FROM events
       UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey) FROM lineitem""",
)
def _(t: Tables):
    return write_summary(
        {
            "conversations": (t.conversations, "conv_id"),
            "events": (t.events, "user_id"),
            "lineitem": (t.lineitem, "l_orderkey"),
        }
    )


PART_TEXT = "concat('PART-', cast(p_partkey as string), '-', repeat(p_name, 6))"


@query("p2_id_cast", f"SELECT p_partkey, {PART_TEXT} AS part_id FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", fn.id_text(F.expr(PART_TEXT)).alias("part_id"))


LONG_ID = "concat(repeat('PART-', 12), cast(floor(p_partkey / 2) as int), '-', p_brand)"


@query(
    "p2_id_full",
    f"""SELECT part_id, max(p_retailprice) AS price, count(*) AS n FROM (SELECT {LONG_ID} AS part_id, p_retailprice FROM part) GROUP BY ALL""",
)
def _(t: Tables):
    """Ids that agree in their first 60 characters stay apart, through typing and deduplication."""
    parts = t.part.select(fn.id_text(F.expr(LONG_ID)).alias("part_id"), "p_partkey", F.col("p_retailprice").alias("price"))
    newest = latest_version(parts, ["part_id"], ["price"], tie_break=["p_partkey"])
    counts = parts.groupBy("part_id").agg(F.count(F.lit(1)).alias("n"))
    return newest.select("part_id", "price").join(counts, "part_id")


# Prices in eighths and thousandths: ties whose exact binary value decides.
TIES = "p_retailprice, cast(p_partkey as double) / 8.0, cast(p_partkey as double) / 1000.0, cast(0 - p_partkey as double) / 200.0, cast(p_partkey as double) * 1e6 + 0.375"


@query(
    "s11_float_ties",
    f"""SELECT p_partkey, n, printf('%.2f', x) AS text FROM (
            SELECT p_partkey, unnest(range(5)) AS n, unnest([{TIES}]) AS x FROM part)
        UNION ALL SELECT 0 - p_partkey, 0, CASE WHEN p_size % 3 = 0 THEN 'inf' WHEN p_size % 3 = 1 THEN '-inf' END FROM part""",
)
def _(t: Tables):
    values = t.part.select("p_partkey", F.posexplode(F.expr(f"array({TIES})")).alias("n", "x"))
    edge = F.when(F.col("p_size") % 3 == 0, float("inf")).when(F.col("p_size") % 3 == 1, float("-inf")).otherwise(float("nan"))
    edges = t.part.select((-F.col("p_partkey")).alias("p_partkey"), F.lit(0).alias("n"), edge.alias("x"))
    rows = values.unionByName(edges)
    return rows.select("p_partkey", F.col("n").cast("long").alias("n"), fn.float_text(F.col("x")).alias("text"))


DAY_TEXT = (
    "case when o_orderkey % 7 = 0 then 'n/a' when o_orderkey % 7 = 1 then '2025-13-02' when o_orderkey % 7 = 2 then '' "
    "when o_orderkey % 7 = 3 then concat(cast(cast(o_orderdate as date) as string), ' 08:00:03') "
    "else cast(cast(o_orderdate as date) as string) end"
)


@query("p3_try_date", f"SELECT o_orderkey, TRY_CAST({DAY_TEXT} AS DATE) AS day FROM orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", fn.to_date(F.expr(DAY_TEXT)).alias("day"))


TIME_TEXT = (
    "case when event_id % 7 = 0 then 'n/a' when event_id % 7 = 1 then '' "
    "else concat(cast(cast(ts as date) as string), ' 08:15:0', cast(event_id % 10 as string), '.25') end"
)


@query("p4_try_timestamp", f"SELECT event_id, TRY_CAST({TIME_TEXT} AS TIMESTAMP) AS at FROM events")
def _(t: Tables):
    return t.events.select("event_id", fn.to_timestamp(F.expr(TIME_TEXT)).alias("at"))


NUMBER_TEXT = (
    "case when o_orderkey % 9 = 0 then 'n/a' when o_orderkey % 9 = 1 then '' when o_orderkey % 9 = 2 then '1e3' "
    "when o_orderkey % 9 = 3 then '12345678901234567890' "
    "when o_orderkey % 9 = 4 then concat(' ', cast(o_custkey as string), ' ') "
    "else concat(cast(o_orderkey as string), '.', cast(100 + o_custkey % 900 as string)) end"
)


@query(
    "p5_try_decimal",
    f"""SELECT o_orderkey, TRY_CAST(raw AS DECIMAL(18,2)) AS money, TRY_CAST(raw AS DECIMAL(9,4)) AS rate,
               TRY_CAST(raw AS DECIMAL(10,6)) AS geo
        FROM (SELECT o_orderkey, {NUMBER_TEXT} AS raw FROM orders)""",
)
def _(t: Tables):
    raw = t.orders.select("o_orderkey", F.expr(NUMBER_TEXT).alias("raw"))
    return raw.select(
        "o_orderkey",
        fn.to_decimal("raw").alias("money"),
        fn.to_decimal("raw", 9, 4).alias("rate"),
        fn.to_decimal("raw", 10, 6).alias("geo"),
    )


INT_TEXT = (
    "case when o_orderkey % 6 = 0 then '1.0' when o_orderkey % 6 = 1 then 'n/a' "
    "when o_orderkey % 6 = 2 then concat(' ', cast(o_custkey as string), ' ') when o_orderkey % 6 = 3 then '99999999999' "
    "else cast(-o_custkey as string) end"
)


@query(
    "p6_try_int",
    f"""SELECT o_orderkey, CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN TRY_CAST(raw AS INTEGER) END AS n
        FROM (SELECT o_orderkey, {INT_TEXT} AS raw FROM orders)""",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", fn.to_int(F.expr(INT_TEXT)).alias("n"))


SEGMENT_TEXT = "concat('  ', lower(substr(c_mktsegment, 1, 3)), substr(c_mktsegment, 4), ' ')"


@query(
    "p7_normalise",
    f"""SELECT c_custkey, trim({SEGMENT_TEXT}) AS text, upper(trim({SEGMENT_TEXT})) AS code,
               lower(trim({SEGMENT_TEXT})) AS address FROM customer""",
)
def _(t: Tables):
    raw = F.expr(SEGMENT_TEXT)
    return t.customer.select(
        "c_custkey", fn.clean_text(raw).alias("text"), fn.clean_code(raw).alias("code"), fn.clean_lower(raw).alias("address")
    )


FLAG_TEXT = (
    "case l_partkey % 9 when 0 then '1' when 1 then 'TRUE' when 2 then ' oui ' when 3 then 'Yes' when 4 then '0' "
    "when 5 then 'non' when 6 then '' when 7 then 'a, b' end"
)


@query(
    "p9_flags",
    f"""SELECT raw, coalesce(lower(trim(raw)) IN ('1', 'true', 'oui', 'yes'), false) AS flag,
               raw IS NOT NULL AND trim(raw) <> '' AS present, count(*) AS n
        FROM (SELECT {FLAG_TEXT} AS raw FROM lineitem) GROUP BY ALL""",
)
def _(t: Tables):
    raw = t.lineitem.select(F.expr(FLAG_TEXT).alias("raw"))
    return (
        raw.select("raw", fn.flag("raw").alias("flag"), fn.flag_present("raw").alias("present"))
        .groupBy("raw", "flag", "present")
        .agg(F.count(F.lit(1)).alias("n"))
    )


MAYBE_FLAG = "case when c_custkey % 5 = 0 then null else c_acctbal > 0 end"


@query(
    "p10_defaults",
    f"SELECT c_custkey, coalesce({MAYBE_FLAG}, false) AS off, coalesce({MAYBE_FLAG}, true) AS on_ FROM customer",
)
def _(t: Tables):
    value = F.expr(MAYBE_FLAG)
    return t.customer.select(
        "c_custkey", F.coalesce(value, F.lit(False)).alias("off"), F.coalesce(value, F.lit(True)).alias("on_")
    )


MAYBE_TEXT = "case when c_nationkey % 3 = 0 then '' when c_nationkey % 3 = 1 then c_mktsegment end"


@query("p11_nullif", f"SELECT c_custkey, nullif({MAYBE_TEXT}, '') AS scope FROM customer")
def _(t: Tables):
    return t.customer.select("c_custkey", fn.blank_to_null(F.expr(MAYBE_TEXT)).alias("scope"))


@query(
    "p12_full_name",
    f"""SELECT c_custkey, coalesce({MAYBE_TEXT}, '') || ' ' || coalesce(nullif(c_name, 'Customer#000000001'), '')
               AS full_name FROM customer""",
)
def _(t: Tables):
    last = F.nullif(F.col("c_name"), F.lit("Customer#000000001"))
    return t.customer.select("c_custkey", fn.full_name(F.expr(MAYBE_TEXT), last).alias("full_name"))


@query(
    "p13_date_key",
    f"""SELECT o_orderkey, CAST(strftime(TRY_CAST({DAY_TEXT} AS DATE), '%Y%m%d') AS INTEGER) AS day_key FROM orders""",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", fn.date_key(fn.to_date(F.expr(DAY_TEXT))).alias("day_key"))


MONTH_PARTS = (
    "case when o_orderstatus = 'P' then null else year(o_orderdate) end",
    "case when o_orderpriority = '5-LOW' then 13 else nullif(month(o_orderdate), 12) end",
)


@query(
    "p14_month_date",
    f"""SELECT o_orderkey, CASE WHEN m BETWEEN 1 AND 12 AND y IS NOT NULL
               THEN make_date(CAST(y AS BIGINT), CAST(m AS BIGINT), 1) END AS month_start
        FROM (SELECT o_orderkey, {MONTH_PARTS[0]} AS y, {MONTH_PARTS[1]} AS m FROM orders)""",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", fn.month_start(*[F.expr(p) for p in MONTH_PARTS]).alias("month_start"))


CALENDAR_SQL = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS annee,
    CAST(quarter(d) AS INTEGER) AS trimestre, CAST(month(d) AS INTEGER) AS mois, CAST(day(d) AS INTEGER) AS jour,
    strftime(d, '%B') AS nom_mois, strftime(d, '%A') AS nom_jour, CAST(dayofweek(d) + 1 AS INTEGER) AS numero_jour_semaine,
    CAST(year(d) * 100 + month(d) AS INTEGER) AS annee_mois_key, strftime(d, '%Y-%m') AS annee_mois"""


@query("p15_calendar", f"SELECT {CALENDAR_SQL} FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)")
def _(t: Tables):
    days = t.lineitem.select(F.col("l_shipdate").cast("date").alias("d")).distinct()
    return days.select(*fn.calendar_attributes("d"))


NULL_TOKEN = fn.keys.NULL_TOKEN


@query(
    "p16_surrogate_key",
    f"""SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS customer_key,
               sha256(coalesce(CAST(c_nationkey AS VARCHAR), '{NULL_TOKEN}') || '-' || coalesce({MAYBE_TEXT}, '{NULL_TOKEN}')) AS scope_key,
               sha256('SEGMENT-' || c_mktsegment) AS status_key
        FROM customer""",
)
def _(t: Tables):
    return t.customer.select(
        "c_custkey",
        fn.surrogate_key("c_custkey").alias("customer_key"),
        fn.surrogate_key("c_nationkey", F.expr(MAYBE_TEXT)).alias("scope_key"),
        fn.surrogate_key(F.lit("SEGMENT"), "c_mktsegment").alias("status_key"),
    )


@query(
    "p17_unknown_row",
    """SELECT sha256(CAST(s_suppkey AS VARCHAR)) AS supplier_key, CAST(s_suppkey AS VARCHAR) AS supplier_id, s_name,
              CAST(s_acctbal AS DECIMAL(18,2)) AS balance, true AS is_active FROM supplier
       UNION ALL SELECT sha256('__UNKNOWN__'), '__UNKNOWN__', 'Supplier inconnu', NULL, true""",
)
def _(t: Tables):
    rows = t.supplier.select(
        fn.surrogate_key("s_suppkey").alias("supplier_key"),
        F.col("s_suppkey").cast("string").alias("supplier_id"),
        "s_name",
        F.col("s_acctbal").cast("decimal(18,2)").alias("balance"),
        F.lit(True).alias("is_active"),
    )
    member = {"supplier_key": fn.unknown_key(), "supplier_id": fn.UNKNOWN, "s_name": "Supplier inconnu", "is_active": True}
    return with_unknown(rows, member)


@query(
    "p18_int_div",
    "SELECT event_id, CAST(floor(CAST(round(value * 1000) AS BIGINT) / 1000) AS BIGINT) AS seconds FROM events",
)
def _(t: Tables):
    millis = t.events.select("event_id", F.round(F.col("value") * 1000).cast("long").alias("ms"))
    return millis.select("event_id", F.expr("ms div 1000").alias("seconds"))


# Rate with two decimals, rounded half up on whole numbers so that both engines agree.
RATE_SQL = """CAST(CASE WHEN n = 0 THEN 0 ELSE (((n - failed) * 20000 + n) // (2 * n)) / 100 END AS DECIMAL(5,2)) AS pass_rate,
    CASE WHEN failed = 0 THEN 'pass' WHEN failed * 100 < n * 5 THEN 'warn' ELSE 'fail' END AS status"""


@query(
    "p19_classify",
    f"""WITH totals AS (SELECT count(*) AS n, CAST(sum(CASE WHEN l_quantity < 2 THEN 1 ELSE 0 END) AS BIGINT) AS low,
                               CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS high,
                               CAST(sum(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM lineitem),
             checks AS (SELECT 'high' AS check_name, n, high AS failed FROM totals UNION ALL SELECT 'low', n, low FROM totals
                        UNION ALL SELECT 'missing', n, missing FROM totals)
        SELECT check_name, n AS records_checked, failed AS records_failed, {RATE_SQL} FROM checks""",
)
def _(t: Tables):
    signed = t.lineitem.select(
        (F.col("l_quantity") - 2).alias("low"), (F.lit(0.05) - F.col("l_discount")).alias("high"), F.col("l_orderkey").alias("missing")
    )
    checks = [Check("lineitem", "low", "range_check"), Check("lineitem", "high", "range_check"), Check("lineitem", "missing", "null_check")]
    log = quality_log({"lineitem": signed}, checks, F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    return log.select(F.col("column_name").alias("check_name"), "records_checked", "records_failed", "pass_rate", "status")


@query("p20_zero_to_null", "SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN CAST(p_size % 4 AS VARCHAR) END AS error FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", fn.zero_to_null(F.col("p_size") % 4).alias("error"))


LOAD_TIME = "2026-01-01 06:00:00"


@query("p21_load_time", f"SELECT r_regionkey, r_name, TIMESTAMP '{LOAD_TIME}' AS inserted_at FROM region")
def _(t: Tables):
    return t.region.withColumn("inserted_at", F.lit(LOAD_TIME).cast("timestamp_ntz"))


@query(
    "p22_tolerant_parse",
    f"""SELECT o_orderkey, coalesce(TRY_CAST(raw AS DOUBLE), -1.0) AS number,
               coalesce(CAST(trunc(TRY_CAST(raw AS DOUBLE)) AS INTEGER), -1) AS whole
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 3 THEN NULL ELSE {NUMBER_TEXT} END AS raw FROM orders)""",
)
def _(t: Tables):
    raw = t.orders.select("o_orderkey", F.expr(f"case when o_orderkey % 9 = 3 then null else {NUMBER_TEXT} end").alias("raw"))
    return raw.select("o_orderkey", fn.number_or("raw", -1.0).alias("number"), fn.int_or("raw", -1).alias("whole"))


# Filters


@query("f1_key_not_null", "SELECT c_custkey, key FROM (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS key FROM customer) WHERE key IS NOT NULL")
def _(t: Tables):
    keyed = t.customer.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("key"))
    return keyed.where(F.col("key").isNotNull())


@query(
    "f2_soft_delete",
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE NOT (o_orderpriority = '5-LOW') GROUP BY o_orderstatus",
)
def _(t: Tables):
    rows = t.orders.withColumn("is_deleted", F.col("o_orderpriority") == "5-LOW")
    return rows.where(~F.col("is_deleted")).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("f3_active", "SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_nationkey")
def _(t: Tables):
    rows = t.customer.withColumn("is_active", F.col("c_acctbal") > 0)
    return rows.where("is_active").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query("f4_non_empty", f"SELECT c_custkey FROM customer WHERE {MAYBE_TEXT} IS NOT NULL AND {MAYBE_TEXT} <> ''")
def _(t: Tables):
    address = F.expr(MAYBE_TEXT)
    return t.customer.where(address.isNotNull() & (address != "")).select("c_custkey")


AS_OF = "2024-01-25 12:00:00"


@query("f6_rolling_window", f"SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAYS")
def _(t: Tables):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return t.events.where(F.col("ts") >= as_of - F.expr("INTERVAL 7 DAYS")).select("event_id", "ts")


@query("f7_not_in", "SELECT event_id, event_type FROM events WHERE nullif(event_type, 'signup') NOT IN ('click', 'view')")
def _(t: Tables):
    kind = F.nullif(F.col("event_type"), F.lit("signup"))
    return t.events.where(~kind.isin("click", "view")).select("event_id", "event_type")


@query(
    "f8_both_parts",
    f"SELECT o_orderkey FROM orders WHERE {MONTH_PARTS[0]} IS NOT NULL AND {MONTH_PARTS[1]} IS NOT NULL",
)
def _(t: Tables):
    year, month = (F.expr(p) for p in MONTH_PARTS)
    return t.orders.where(year.isNotNull() & month.isNotNull()).select("o_orderkey")


# Business formulas. The SQL rounds half up on whole cents.

CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


def cents(expression: str) -> str:
    """A count of cents as money."""
    return f"CAST(CAST(({expression}) AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))"


@query(
    "b1_instalment",
    """SELECT o_orderkey, CASE WHEN p > 0 THEN CAST(round(p * r / (1 - pow(1 + r, -n)), 2) AS DECIMAL(18,2)) ELSE 0 END AS monthly
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS p,
                    (0.02 + (o_orderkey % 25) / 1000.0) / 12 AS r, 180 + 60 * (o_custkey % 4) AS n FROM orders)""",
)
def _(t: Tables):
    principal = F.when(F.col("o_orderstatus") == "P", 0.0).otherwise(F.col("o_totalprice"))
    rate = F.lit(0.02) + (F.col("o_orderkey") % 25) / 1000.0
    months = F.lit(180) + 60 * (F.col("o_custkey") % 4)
    return t.orders.select("o_orderkey", fn.instalment(principal, rate, months).alias("monthly"))


@query(
    "b2_vat_split",
    f"""SELECT o_orderkey, {cents("net")} AS ht, {cents("c - net")} AS tva, {cents("(c * 103 + 50) // 100")} AS total
        FROM (SELECT o_orderkey, {CENTS} AS c, ({CENTS} * 5 + 3) // 6 AS net FROM orders)""",
)
def _(t: Tables):
    parts = fn.sale_amounts(F.col("o_totalprice"))
    return t.orders.select("o_orderkey", *[value.alias(name) for name, value in parts.items()])


@query(
    "b3_commission_split",
    f"""SELECT o_orderkey, {cents("g")} AS gross, {cents("(g * 85 + 50) // 100")} AS net, {cents("p")} AS partner,
               {cents("g - p")} AS internal
        FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN (g * 40 + 50) // 100 ELSE 0 END AS p
              FROM (SELECT o_orderkey, o_orderstatus, ({CENTS} * (200 + o_custkey % 300) + 5000) // 10000 AS g FROM orders))""",
)
def _(t: Tables):
    parts = fn.commission_split(
        F.col("o_totalprice"),
        (F.lit(200) + F.col("o_custkey") % 300) / F.lit(10000),
        F.nullif(F.col("o_orderstatus"), F.lit("P")),
        F.lit("0.40"),
    )
    return t.orders.select("o_orderkey", *[value.alias(name) for name, value in parts.items()])


@query(
    "b4_simple_interest",
    f"""SELECT o_orderkey, {cents("i")} AS interest, {cents("c + i")} AS repayment
        FROM (SELECT o_orderkey, {CENTS} AS c, ({CENTS} * 9 * (6 + o_custkey % 30) + 600) // 1200 AS i FROM orders)""",
)
def _(t: Tables):
    parts = fn.simple_interest(F.col("o_totalprice"), F.lit("0.09"), 6 + F.col("o_custkey") % 30)
    return t.orders.select("o_orderkey", *[value.alias(name) for name, value in parts.items()])


@query(
    "b5_capital_gain",
    f"""SELECT o_orderkey, {cents("g")} AS gross, {cents("CASE WHEN g > 0 THEN (g * 664 + 500) // 1000 ELSE g END")} AS net
        FROM (SELECT o_orderkey, {CENTS} - 20000000 AS g FROM orders)""",
)
def _(t: Tables):
    parts = fn.capital_gain(F.lit("200000"), F.col("o_totalprice"))
    return t.orders.select("o_orderkey", *[value.alias(name) for name, value in parts.items()])


@query(
    "b6_yield",
    f"""SELECT o_orderkey, CAST(CAST((rent * 120000 * 2 + c) // (2 * c) AS DECIMAL(18,0)) / 10000 AS DECIMAL(18,4)) AS yield
        FROM (SELECT o_orderkey, 50000 + o_custkey AS rent, greatest({CENTS}, 100) AS c FROM orders)""",
)
def _(t: Tables):
    rent = (F.lit(50000) + F.col("o_custkey")).cast("decimal(18,2)") / F.lit(100)
    return t.orders.select("o_orderkey", fn.annual_yield(rent, F.col("o_totalprice")).alias("yield"))


@query(
    "b7_occupancy",
    """SELECT p_partkey, CAST(r / 10000.0 AS DECIMAL(9,4)) AS rate,
              CAST(CAST((c * r + 5000) // 10000 AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) AS rent
       FROM (SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS c,
                    CASE WHEN p_size <= 30 THEN ((30 - p_size) * 20000 + 30) // 60 ELSE 0 END AS r FROM part)""",
)
def _(t: Tables):
    parts = fn.occupancy(F.col("p_size"), F.col("p_retailprice"))
    return t.part.select("p_partkey", *[value.alias(name) for name, value in parts.items()])


@query(
    "b8_tax_result",
    f"""SELECT o_orderkey, {cents("r")} AS result, {cents("(greatest(r, 0) * 30 + 50) // 100")} AS tax
        FROM (SELECT o_orderkey, {CENTS} - 5000000 - 12345 * (o_custkey % 1000) AS r FROM orders)""",
)
def _(t: Tables):
    depreciation = (F.lit(12345) * (F.col("o_custkey") % 1000)).cast("decimal(18,2)") / F.lit(100)
    parts = fn.tax_result(F.col("o_totalprice"), F.lit("50000"), depreciation)
    return t.orders.select("o_orderkey", *[value.alias(name) for name, value in parts.items()])


@query(
    "b9_elapsed_days",
    f"""SELECT o_orderkey, CAST(date_diff('day', TRY_CAST({DAY_TEXT} AS DATE), DATE '2002-01-01') AS INTEGER) AS days FROM orders""",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", fn.elapsed_days(F.lit("2002-01-01").cast("date"), fn.to_date(F.expr(DAY_TEXT))).alias("days"))
