"""Joins, aggregates, versions, set operations and measures on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratastar import functions as fn
from stratastar import operators as op
from stratastar.examples import retail
from stratastar.examples.columns import CALENDAR_SQL, LOAD_TIME, RATE_SQL
from stratastar.examples.registry import Tables, query
from stratastar.plans.gold import dimension, fact
from stratastar.plans.semantic import Measure, Model, measure_query, propagate, related, store_by_year
from stratastar.session import materialise, materialise_all, scratch_path
from stratastar.sources import bronze
from stratastar.sources.state import LatestState

STAR = retail.STAR_SQL


# Layers


@query("p1_silver_orders", f"WITH {retail.SILVER_ORDERS_SQL} SELECT * FROM silver_orders")
def _(t: Tables):
    return retail.silver_orders(t)


@query("p1_silver_lines", f"WITH {retail.SILVER_LINES_SQL} SELECT * FROM silver_lines")
def _(t: Tables):
    return retail.silver_lines(t)


# Lookups


@query(
    "j1_lookup_unknown",
    f"WITH {retail.DIM_CUSTOMER_SQL} SELECT * FROM dim_customer",
)
def _(t: Tables):
    return retail.master_dimension(t, "dim_customer")


@query("j2_star_fact", f"{STAR} SELECT * FROM fact_line")
def _(t: Tables):
    return retail.retail_model(t, "fact_line").tables["fact_line"]


@query("j2_star_keys_only", f"{STAR} SELECT * FROM fact_line")
def _(t: Tables):
    """The star of `j2_star_fact` with no dimension joined on its own: keys travel, the wide row moves once."""
    stored = materialise_all(
        {
            "dim_part": retail.master_dimension(t, "dim_part"),
            "dim_supplier": retail.master_dimension(t, "dim_supplier"),
            "dim_statut": retail.dim_status(t).where("domaine_statut = 'LINE'"),
        }
    )
    return fact(retail.silver_lines(t), retail.FACT_LINE, stored, direct_up_to=-1, unique=True)


@query("j3_status_lookup", f"{STAR} SELECT order_id, status, statut_key FROM fact_order")
def _(t: Tables):
    statuses = materialise(retail.dim_status(t), "dim_statut")
    orders = retail.silver_orders(t).where(~F.col("is_deleted"))
    return op.status_lookup(orders, statuses, "ORDER", "status", spread_by=["order_id"]).select("order_id", "status", "statut_key")


LONG_STATUS = "concat(repeat(concat(o_orderstatus, '-', o_orderpriority, ' '), 12), cast(o_orderkey % 7 as string))"


@query(
    "j3_status_long",
    f"""SELECT o_orderkey, s AS status, sha256('ORDER-' || upper(trim(s))) AS statut_key
        FROM (SELECT o_orderkey, {LONG_STATUS} AS s FROM orders)""",
)
def _(t: Tables):
    """Statuses of more than a hundred characters find their members."""
    orders = t.orders.select("o_orderkey", F.expr(LONG_STATUS).alias("status"))
    statuses = materialise(op.domain_values({"ORDER": (orders, "status")}), "dim_statut")
    return op.status_lookup(orders, statuses, "ORDER", "status")


@query(
    "j4_anti_runlog",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
       WHERE isodow(o_orderdate) < 6 AND CAST(o_orderdate AS DATE) NOT IN (
           SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_quantity = 50)""",
)
def _(t: Tables):
    journal = {"lineitem": (t.lineitem.where("l_quantity = 50"), "l_shipdate")}
    log = bronze.run_log_rows(journal, F.lit(LOAD_TIME).cast("timestamp_ntz"))
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return op.days_to_process(days, log, exclude_holidays=False)


@query(
    "j5_map_enrich",
    """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(t: Tables):
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    joined = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", "n_name", "r_name")


@query(
    "j6_anti_composite",
    """SELECT DISTINCT l_partkey, l_suppkey FROM lineitem l WHERE NOT EXISTS (
           SELECT 1 FROM lineitem x WHERE x.l_returnflag = 'R' AND x.l_partkey = l.l_partkey AND x.l_suppkey = l.l_suppkey)""",
)
def _(t: Tables):
    returned = t.lineitem.where("l_returnflag = 'R'")
    return op.never_matched(t.lineitem.select("l_partkey", "l_suppkey"), returned, ["l_partkey", "l_suppkey"]).distinct()


@query(
    "j7_granted_values",
    """SELECT c_custkey FROM customer
       WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)
          OR c_mktsegment IN (SELECT c_mktsegment FROM customer WHERE c_acctbal > 9990)""",
)
def _(t: Tables):
    nations = t.supplier.where("s_acctbal > 9000").select("s_nationkey")
    segments = t.customer.where("c_acctbal > 9990").select("c_mktsegment")
    return t.customer.where(F.col("c_nationkey").isin(nations) | F.col("c_mktsegment").isin(segments)).select("c_custkey")


@query(
    "j8_relationship",
    f"""{STAR} SELECT order_id, amount, c_name, c_mktsegment FROM fact_order JOIN dim_customer USING (customer_key)""",
)
def _(t: Tables):
    model = retail.retail_model(t, "fact_order", reads={"fact_order": {"customer_key"}})
    return related(model, "fact_order", "dim_customer", ["c_name", "c_mktsegment"]).select(
        "order_id", "amount", "c_name", "c_mktsegment"
    )


@query(
    "j9_propagation",
    f"""{STAR} SELECT order_id, amount FROM fact_order WHERE customer_key IN (
           SELECT customer_key FROM dim_customer WHERE c_mktsegment = 'BUILDING')
        AND date_order_key // 10000 = 1997""",
)
def _(t: Tables):
    model = retail.retail_model(t, "fact_order", reads={"fact_order": {"customer_key"}})
    filters = {
        "dim_customer": model.tables["dim_customer"].where("c_mktsegment = 'BUILDING'"),
        "dim_date": model.tables["dim_date"].where("annee = 1997"),
    }
    return propagate(model, "fact_order", filters).select("order_id", "amount")


@query(
    "j9_pruned_years",
    f"""{STAR} SELECT order_id, amount FROM fact_order WHERE customer_key IN (
           SELECT customer_key FROM dim_customer WHERE c_mktsegment = 'BUILDING')
        AND date_order_key // 10000 = 1997""",
)
def _(t: Tables):
    """The same filters on a fact stored by year: the other years' files stay closed."""
    model = retail.retail_model(t, "fact_order", reads={"fact_order": {"customer_key"}})
    stored = store_by_year(model.tables["fact_order"], "date_order_key", scratch_path(t.spark, "by-year"))
    model = Model({**model.tables, "fact_order": stored}, model.relationships, model.measures, by_year={"fact_order": "date_order_key"})
    filters = {
        "dim_customer": model.tables["dim_customer"].where("c_mktsegment = 'BUILDING'"),
        "dim_date": model.tables["dim_date"].where("annee = 1997"),
    }
    return propagate(model, "fact_order", filters).select("order_id", "amount")


@query(
    "j10_drill_across",
    f"""{STAR}, o AS (SELECT date_order_key // 10000 AS annee, statut_value, sum(amount) AS revenue, count(*) AS n_orders
                      FROM fact_order LEFT JOIN dim_statut USING (statut_key) GROUP BY ALL),
        l AS (SELECT date_ship_key // 10000 AS annee, statut_value, sum(amount) AS shipped, count(*) AS n_lines
              FROM fact_line LEFT JOIN dim_statut USING (statut_key) GROUP BY ALL),
        g AS (SELECT date_target_key // 10000 AS annee, statut_value, sum(target) AS target
              FROM fact_target LEFT JOIN dim_statut USING (statut_key) GROUP BY ALL)
        SELECT annee, statut_value, revenue, n_orders, shipped, n_lines, target,
               CAST(revenue AS DOUBLE) / nullif(CAST(target AS DOUBLE), 0) AS attainment
        FROM o FULL JOIN l USING (annee, statut_value) FULL JOIN g USING (annee, statut_value)""",
)
def _(t: Tables):
    names = ["revenue", "n_orders", "shipped", "n_lines", "target", "attainment"]
    return retail.measured(t, names, [("dim_date", "annee"), ("dim_statut", "statut_value")])


# Aggregates


@query(
    "a1_freshness",
    f"""SELECT 'bronze' AS table_schema, 'events' AS table_name, max(ts) AS last_load_time, count(*) AS row_count,
               TIMESTAMP '{LOAD_TIME}' AS checked_at FROM events""",
)
def _(t: Tables):
    return op.freshness({("bronze", "events"): (t.events, "ts")}, F.lit(LOAD_TIME).cast("timestamp_ntz"))


@query(
    "a2_conditional_count",
    """SELECT l_returnflag, CAST(sum(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_full_price
       FROM lineitem GROUP BY l_returnflag""",
)
def _(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.sum(F.when(F.col("l_discount") == 0, 1).otherwise(0)).alias("n_full_price"))


@query(
    "a3_duplicates",
    """SELECT 'l_orderkey' AS column_name, count(*) AS records_checked, count(*) - count(DISTINCT l_orderkey) AS records_failed FROM lineitem
       UNION ALL SELECT 'o_orderkey', count(*), count(*) - count(DISTINCT o_orderkey) FROM orders""",
)
def _(t: Tables):
    checks = [op.Check("lineitem", "l_orderkey", "duplicate_check"), op.Check("orders", "o_orderkey", "duplicate_check")]
    log = op.quality_log({"lineitem": t.lineitem, "orders": t.orders}, checks, F.lit(LOAD_TIME).cast("timestamp_ntz"))
    return log.select("column_name", "records_checked", "records_failed")


@query("a4_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _(t: Tables):
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("a5_group_count", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(t: Tables):
    return t.events.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a6_group_list",
    """WITH sizes AS (SELECT c_nationkey, count(DISTINCT c_custkey) AS group_size FROM customer GROUP BY ALL),
            pages AS (SELECT DISTINCT c_nationkey, c_custkey, group_size,
                             ('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT
                             % 4 AS page
                      FROM customer JOIN sizes USING (c_nationkey))
       SELECT c_nationkey, page, group_size, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS members
       FROM pages GROUP BY ALL""",
)
def _(t: Tables):
    pages = op.member_pages(t.customer, "c_nationkey", "c_custkey", 4)
    return pages.withColumn("members", F.array_join("members", ","))


@query(
    "a6_group_rows",
    """SELECT l_suppkey, l_partkey, count(*) OVER (PARTITION BY l_suppkey) AS group_size
       FROM (SELECT DISTINCT CASE WHEN l_quantity <= 17 THEN -1 ELSE l_suppkey END AS l_suppkey, l_partkey FROM lineitem)""",
)
def _(t: Tables):
    """One group holds a third of the rows; the grain is the same for it."""
    hot = F.when(F.col("l_quantity") <= 17, -1).otherwise(F.col("l_suppkey"))
    return op.group_members(t.lineitem.select(hot.alias("l_suppkey"), "l_partkey"), "l_suppkey", "l_partkey")


@query(
    "a7_distinct_union",
    "SELECT c_nationkey AS nation FROM customer WHERE c_acctbal < -900 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
)
def _(t: Tables):
    customers = t.customer.where("c_acctbal < -900").select(F.col("c_nationkey").alias("nation"))
    suppliers = t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("nation"))
    return customers.union(suppliers).distinct().orderBy("nation")


BY_SEGMENT = [("dim_date", "annee"), ("dim_customer", "c_mktsegment")]


def by_segment(columns: str) -> str:
    return f"""{STAR} SELECT date_order_key // 10000 AS annee, c_mktsegment, {columns}
               FROM fact_order JOIN dim_customer USING (customer_key) GROUP BY ALL"""


@query("a8_sum", by_segment("sum(amount) AS revenue, count(*) AS n_orders"))
def _(t: Tables):
    return retail.measured(t, ["revenue", "n_orders"], BY_SEGMENT)


@query("a8_count", f"{STAR} SELECT part_id, count(*) AS n_lines FROM (SELECT p_type AS part_id FROM fact_line JOIN part ON CAST(p_partkey AS VARCHAR) = fact_line.part_id) GROUP BY ALL")
def _(t: Tables):
    counts = retail.measured(t, ["n_lines"], [("dim_part", "p_type")])
    return counts.withColumnRenamed("p_type", "part_id")


@query("a8_distinct", "SELECT c_mktsegment, count(DISTINCT c_custkey) AS n_customers FROM customer GROUP BY ALL UNION ALL SELECT 'INCONNU', 1")
def _(t: Tables):
    return retail.measured(t, ["n_customers"], [("dim_customer", "c_mktsegment")])


@query(
    "a8_distinct_merged",
    """SELECT 'year and status' AS grouping, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY ALL
       UNION ALL SELECT 'year', CAST(year(o_orderdate) AS INTEGER), NULL, count(DISTINCT o_custkey) FROM orders GROUP BY ALL
       UNION ALL SELECT 'status', NULL, o_orderstatus, count(DISTINCT o_custkey) FROM orders GROUP BY ALL
       UNION ALL SELECT 'all', NULL, NULL, count(DISTINCT o_custkey) FROM orders""",
)
def _(t: Tables):
    """Customers of orders at four groupings, all from one stored state."""
    rows = t.orders.select(F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("status"), "o_custkey")
    numbers = materialise(op.member_numbers(t.orders.select("o_custkey")), "numbers")
    state = materialise(op.distinct_state(rows, ["year", "status"], F.col("o_custkey"), numbers), "state")
    results = []
    for groups in (["year", "status"], ["year"], ["status"], []):
        counted = op.distinct_counts(state, groups, "n_customers")
        names = [F.col(g) if g in groups else F.lit(None).cast(kind).alias(g) for g, kind in (("year", "int"), ("status", "string"))]
        results.append(counted.select(F.lit(" and ".join(groups) or "all").alias("grouping"), *names, "n_customers"))
    return op.setops.union_all(results)


@query(
    "a8_distinct_across",
    f"""{STAR} SELECT annee, max(n_buyers) AS n_buyers, max(n_parts) AS n_parts FROM (
          SELECT date_order_key // 10000 AS annee, count(DISTINCT customer_key) AS n_buyers, NULL AS n_parts FROM fact_order GROUP BY ALL
          UNION ALL SELECT date_ship_key // 10000, NULL, count(DISTINCT part_key) FROM fact_line GROUP BY ALL) GROUP BY annee""",
)
def _(t: Tables):
    """Distinct measures of two facts by a common dimension, by bitmaps summed up per date before the join."""
    model = retail.retail_model(t, "fact_order", "fact_line", reads={"fact_order": {"customer_key"}, "fact_line": {"part_key"}})
    tables = {**model.tables, **materialise_all({f: model.tables[f].select(*c) for f, c in (("fact_order", ("customer_key", "date_order_key")), ("fact_line", ("part_key", "date_ship_key")))})}
    measures = {m.name: m for m in (Measure("n_buyers", "distinct", "fact_order", "customer_key"), Measure("n_parts", "distinct", "fact_line", "part_key"))}
    numbers = {(m.table, m.column): op.member_numbers(tables[m.table].select(m.column)) for m in measures.values()}
    return measure_query(Model(tables, model.relationships, measures, numbers), list(measures), [("dim_date", "annee")])


@query("a8_avg", by_segment("CAST(sum(amount) AS DOUBLE) / count(amount) AS mean_order"))
def _(t: Tables):
    return retail.measured(t, ["mean_order"], BY_SEGMENT)


@query("a8_ratio", by_segment("CAST(sum(amount) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS order_value"))
def _(t: Tables):
    return retail.measured(t, ["order_value"], BY_SEGMENT)


@query("a8_filtered_count", by_segment("nullif(count(*) FILTER (customer_key = sha256('__UNKNOWN__')), 0) AS n_unknown_customer"))
def _(t: Tables):
    return retail.measured(t, ["n_unknown_customer"], BY_SEGMENT)


@query(
    "a8_dim_only",
    f"""{STAR} SELECT date_order_key // 10000 AS annee, sum(amount) AS revenue, (SELECT count(*) FROM dim_customer) AS n_customers,
               (SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) FROM customer) AS mean_balance
        FROM fact_order GROUP BY ALL""",
)
def _(t: Tables):
    return retail.measured(t, ["revenue", "n_customers", "mean_balance"], [("dim_date", "annee")])


STOCK_STATUS = "case when p_size <= 20 then 'EN_COMMERCIALISATION' when p_size <= 40 then 'COMMERCIALISE' else 'LIVRE' end"
LOT_STATUS = "case when l_discount = 0.1 and l_tax >= 0.07 then 'DISPONIBLE' else 'VENDU' end"


@query(
    "a9_stock",
    f"""WITH stock AS (SELECT l_partkey, CAST(sum(CASE WHEN {LOT_STATUS} = 'DISPONIBLE' THEN 1 ELSE 0 END) AS INTEGER) AS n
                       FROM lineitem GROUP BY ALL)
        SELECT CAST(p_partkey AS VARCHAR) AS programme_id, coalesce(n, 0) AS nombre_lots_disponibles,
               CASE WHEN coalesce(n, 0) = 0 AND s = 'EN_COMMERCIALISATION' THEN 'COMMERCIALISE'
                    WHEN coalesce(n, 0) > 0 AND s = 'COMMERCIALISE' THEN 'EN_COMMERCIALISATION' ELSE s END AS statut_programme
        FROM (SELECT p_partkey, {STOCK_STATUS} AS s FROM part) LEFT JOIN stock ON p_partkey = l_partkey""",
)
def _(t: Tables):
    programmes = t.part.select(F.col("p_partkey").cast("string").alias("programme_id"), F.expr(STOCK_STATUS).alias("statut_programme"))
    lots = t.lineitem.select(F.col("l_partkey").cast("string").alias("programme_id"), F.expr(LOT_STATUS).alias("statut_lot"))
    return op.reconcile_stock(programmes, lots)


# Versions


@query(
    "w1_latest",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS rn
       FROM events) WHERE rn = 1""",
)
def _(t: Tables):
    return op.latest_version(t.events, ["user_id"], ["ts"])


@query(
    "w1_latest_ties",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linestatus DESC NULLS LAST,
           l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate) AS rn
       FROM lineitem) WHERE rn = 1""",
)
def _(t: Tables):
    return op.latest_version(t.lineitem, ["l_orderkey"], ["l_linestatus"])


@query(
    "w1_conversations",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role, text) AS rn
       FROM conversations) WHERE rn = 1""",
)
def _(t: Tables):
    return op.latest_version(t.conversations, ["conv_id"], ["turn"])


for _policy, _where, _after in (
    ("before", "WHERE event_type <> 'error'", ""),
    ("after", "", "AND event_type <> 'error'"),
):

    @query(
        f"w1_deleted_{_policy}",
        f"""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
            FROM events {_where}) WHERE rn = 1 {_after}""",
    )
    def _(t: Tables, policy=_policy):
        flagged = t.events.withColumn("is_deleted", F.col("event_type") == "error")
        newest = op.latest_version(flagged, ["user_id"], ["ts"], deleted="is_deleted", deleted_policy=policy)
        return newest.select("user_id", "event_id", "event_type")


@query(
    "w1_incremental",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id, event_type, value, is_deleted) AS rn
       FROM (SELECT *, event_type = 'error' AS is_deleted FROM events)) WHERE rn = 1 AND NOT is_deleted""",
)
def _(t: Tables):
    """Newest versions from batches that come late, overlap and come twice: as if all came at once."""
    rows = t.events.withColumn("is_deleted", F.col("event_type") == "error")
    state = LatestState(t.spark, scratch_path(t.spark, "state"), rows.schema, ["user_id"], ["ts"], buckets=16, deleted="is_deleted")
    for batch in ("event_id % 3 = 2", "event_id % 3 <> 1", "event_id % 3 = 1", "event_id % 3 = 2"):
        state.merge(rows.where(batch))
    return state.current()


@query(
    "w1_incremental_touched",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority) AS rn
       FROM orders) WHERE rn = 1""",
)
def _(t: Tables):
    """All orders, then the orders of a few customers again: the second batch opens only their buckets."""
    state = LatestState(t.spark, scratch_path(t.spark, "state"), t.orders.schema, ["o_custkey"], ["o_orderdate"], buckets=32)
    state.merge(t.orders)
    touched = state.merge(t.orders.where("o_custkey in (1, 2, 4)"))
    if len(touched) > 3:
        raise AssertionError(f"three keys touched {len(touched)} buckets")
    return state.current()


@query(
    "w2_dedup_multi",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
           PARTITION BY status, coalesce(scope, 'NO_SCOPE'), coalesce(segment, 'NO_SEGMENT') ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey) AS rn
         FROM (SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus AS status, nullif(o_orderpriority, '5-LOW') AS scope,
                      CASE WHEN o_totalprice > 200000 THEN 'LARGE' END AS segment FROM orders)) WHERE rn = 1""",
)
def _(t: Tables):
    rows = t.orders.select(
        "o_orderkey",
        "o_orderdate",
        "o_totalprice",
        F.col("o_orderstatus").alias("status"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("scope"),
        F.when(F.col("o_totalprice") > 200000, "LARGE").alias("segment"),
    )
    return op.latest_version(
        rows,
        ["status", "scope", "segment"],
        ["o_orderdate", "o_totalprice"],
        tie_break=["o_orderkey"],
        placeholders={"scope": "NO_SCOPE", "segment": "NO_SEGMENT"},
    )


@query(
    "w2_null_keys",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, coalesce(scope, 'NO_SCOPE') ORDER BY ts DESC, event_id) AS rn
       FROM (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id, CASE WHEN value > 50 THEN event_type END AS scope, event_id, ts FROM events)
       WHERE user_id IS NOT NULL) WHERE rn = 1""",
)
def _(t: Tables):
    """A placeholder for one key part does not let NULLs of another part through."""
    rows = t.events.select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), F.when(F.col("value") > 50, F.col("event_type")).alias("scope"), "event_id", "ts"
    )
    return op.latest_version(rows, ["user_id", "scope"], ["ts"], tie_break=["event_id"], placeholders={"scope": "NO_SCOPE"})


@query(
    "w3_latest_nulls_win",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seen_at DESC NULLS FIRST, event_id DESC) AS rn
       FROM (SELECT user_id, event_id, CASE WHEN event_type <> 'error' OR value < 100 THEN ts END AS seen_at FROM events)) WHERE rn = 1""",
)
def _(t: Tables):
    text = F.when((F.col("event_type") != "error") | (F.col("value") < 100), F.col("ts").cast("string")).otherwise("n/a")
    rows = t.events.select("user_id", "event_id", text.alias("seen_at"))
    newest = op.latest_of_extract(rows, "user_id", "seen_at", sequence="event_id")
    return newest.withColumn("seen_at", fn.to_timestamp("seen_at"))


@query(
    "w4_latest_by_sequence",
    "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id",
)
def _(t: Tables):
    return op.latest_version(t.events.select("user_id", "event_id"), ["user_id"], ["event_id"])


# Set operations


@query(
    "u1_dim_date",
    f"""SELECT {CALENDAR_SQL} FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem
        UNION SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders) WHERE d IS NOT NULL""",
)
def _(t: Tables):
    return retail.dim_date(t)


@query("u2_dim_status", f"WITH {retail.DIM_STATUS_SQL} SELECT * FROM dim_statut")
def _(t: Tables):
    return retail.dim_status(t)


@query(
    "u3_dim_union_unknown",
    """SELECT sha256(CAST(p_partkey AS VARCHAR)) AS part_key, CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, p_size,
              p_retailprice FROM part
       UNION ALL SELECT sha256('__UNKNOWN__'), '__UNKNOWN__', 'Produit inconnu', NULL, 'INCONNU', NULL, NULL""",
)
def _(t: Tables):
    return dimension(retail.reference_table(t, "part"), retail.PART, {}, latest=False)


QUALITY = (
    op.Check("fact_order", "customer_id", "null_check"),
    op.Check("fact_order", "margin", "range_check"),
    op.Check("fact_order", "order_id", "duplicate_check"),
    op.Check("fact_order", "customer_id", "duplicate_check"),
    op.Check("fact_line", "quantity", "null_check"),
    op.Check("fact_line", "line_id", "duplicate_check"),
)


@query(
    "u4_quality_log",
    f"""{STAR}, c AS (
        SELECT 'fact_order' AS table_name, 'customer_id' AS column_name, 'null_check' AS check_type, count(*) AS n,
               CAST(sum(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM fact_order
        UNION ALL SELECT 'fact_order', 'margin', 'range_check', count(*), CAST(sum(CASE WHEN amount < 20000 THEN 1 ELSE 0 END) AS BIGINT) FROM fact_order
        UNION ALL SELECT 'fact_order', 'order_id', 'duplicate_check', count(*), count(*) - count(DISTINCT order_id) FROM fact_order
        UNION ALL SELECT 'fact_order', 'customer_id', 'duplicate_check', count(*), count(*) - count(DISTINCT customer_id) FROM fact_order
        UNION ALL SELECT 'fact_line', 'quantity', 'null_check', count(*), CAST(sum(CASE WHEN quantity IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM fact_line
        UNION ALL SELECT 'fact_line', 'line_id', 'duplicate_check', count(*), count(*) - count(DISTINCT line_id) FROM fact_line)
        SELECT TIMESTAMP '{LOAD_TIME}' AS checked_at, 'gold' AS table_schema, table_name, column_name, check_type,
               n AS records_checked, failed AS records_failed, {RATE_SQL} FROM c""",
)
def _(t: Tables):
    tables = retail.retail_model(t, "fact_order", "fact_line", reads={c.table: {c.column} for c in QUALITY}).tables
    orders = tables["fact_order"].withColumn("margin", F.col("amount") - 20000)
    return op.quality_log({"fact_order": orders, "fact_line": tables["fact_line"]}, QUALITY, F.lit(LOAD_TIME).cast("timestamp_ntz"))


@query(
    "u5_freshness_all",
    " UNION ALL ".join(
        f"SELECT 'bronze' AS table_schema, '{name}' AS table_name, max({column}) AS last_load_time, count(*) AS row_count, "
        f"TIMESTAMP '{LOAD_TIME}' AS checked_at FROM {name}"
        for name, column in (("events", "ts"), ("lineitem", "l_shipdate"), ("orders", "o_orderdate"))
    ),
)
def _(t: Tables):
    probes = {
        ("bronze", "events"): (t.events, "ts"),
        ("bronze", "lineitem"): (t.lineitem, "l_shipdate"),
        ("bronze", "orders"): (t.orders, "o_orderdate"),
    }
    return op.freshness(probes, F.lit(LOAD_TIME).cast("timestamp_ntz"))


@query(
    "u6_key_sets",
    """SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49
       EXCEPT SELECT l_suppkey FROM lineitem WHERE l_discount = 0.1 AND l_tax = 0.08 AND l_quantity < 10""",
)
def _(t: Tables):
    taken = t.lineitem.where("l_discount = 0.1 and l_tax = 0.08 and l_quantity < 10").select(F.col("l_suppkey").alias("k"))
    wanted = t.lineitem.where("l_returnflag = 'R' and l_quantity >= 49").select(F.col("l_suppkey").alias("k")).distinct()
    return wanted.join(taken, "k", "left_anti")


# Data tests and logs


@query("t1_not_null", f"WITH {retail.SILVER_ORDERS_SQL} SELECT order_id FROM silver_orders WHERE customer_id IS NULL")
def _(t: Tables):
    return op.not_null_failures(retail.silver_orders(t), "customer_id").select("order_id")


@query("t2_unique", "SELECT l_orderkey, count(*) AS n_records FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(t: Tables):
    return op.unique_failures(t.lineitem, "l_orderkey")


@query(
    "t3_accepted_values",
    "SELECT event_type, count(*) AS n_records FROM events WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY ALL",
)
def _(t: Tables):
    return op.accepted_values_failures(t.events, "event_type", ["click", "view", "purchase"])


@query(
    "t4_quality_empty",
    f"""WITH c AS (SELECT 'l_orderkey' AS column_name, 'duplicate_check' AS check_type, count(*) AS n, count(*) - count(DISTINCT l_orderkey) AS failed
                   FROM lineitem WHERE l_quantity < 0
                   UNION ALL SELECT 'l_tax', 'range_check', count(*), CAST(sum(CASE WHEN l_tax < 0 THEN 1 ELSE 0 END) AS BIGINT)
                   FROM lineitem WHERE l_quantity < 0)
        SELECT column_name, check_type, n AS records_checked, failed AS records_failed, {RATE_SQL} FROM c""",
)
def _(t: Tables):
    checks = [op.Check("lines", "l_orderkey", "duplicate_check"), op.Check("lines", "l_tax", "range_check")]
    log = op.quality_log({"lines": t.lineitem.where("l_quantity < 0")}, checks, F.lit(LOAD_TIME).cast("timestamp_ntz"))
    return log.select("column_name", "check_type", "records_checked", "records_failed", "pass_rate", "status")


@query(
    "t6_run_log",
    """SELECT CAST(event_id AS VARCHAR) AS run_id, 'user-' || user_id AS pipeline_name, 'TEST' AS environment, 'Succeeded' AS status,
              ts AS start_time, ts + INTERVAL 1 MINUTE AS end_time, CAST(floor(CAST(round(value * 100) AS BIGINT) / 1000) AS BIGINT) AS duration_seconds,
              event_id AS rows_processed, CASE WHEN event_type = 'error' THEN '404' END AS error_message, TIMESTAMP '2024-01-28 00:00:00' AS inserted_at
       FROM events WHERE ts >= TIMESTAMP '2024-01-21 00:00:00' AND event_type NOT IN ('signup', 'view')""",
)
def _(t: Tables):
    statements = t.events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("pipeline_name"),
        F.col("event_type").alias("statement_type"),
        F.lit("Succeeded").alias("status"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("end_time"),
        F.round(F.col("value") * 100).cast("long").alias("elapsed_ms"),
        F.col("event_id").alias("row_count"),
        F.when(F.col("event_type") == "error", 404).otherwise(0).alias("error_code"),
    )
    as_of = F.lit("2024-01-28 00:00:00").cast("timestamp_ntz")
    return op.run_log(statements, as_of, environment="TEST", skipped=("signup", "view"))
