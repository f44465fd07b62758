"""Business days, days to process, run log and entity operators on the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratastar import functions as fn
from stratastar import operators as op
from stratastar.examples.columns import LOAD_TIME
from stratastar.examples.registry import Tables, query
from stratastar.session import scratch_path
from stratastar.sources import bronze, ingest, ordered
from stratastar.sources.layout import Layout

SPAN_SQL = """span AS (SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day
                       FROM lineitem)"""

# Easter by the Gauss rule with its two exceptions, for 1900 to 2099.
HOLIDAYS_SQL = """years AS (SELECT DISTINCT year(day) AS y FROM span),
    gauss AS (SELECT y, (19 * (y % 19) + 24) % 30 AS d, (2 * (y % 4) + 4 * (y % 7) + 6 * ((19 * (y % 19) + 24) % 30) + 5) % 7 AS e, y % 19 AS a FROM years),
    easter AS (SELECT y, CAST(make_date(y, 3, 22) + CAST(CASE WHEN d = 29 AND e = 6 THEN 28 WHEN d = 28 AND e = 6 AND a > 10 THEN 27 ELSE d + e END AS INTEGER) AS DATE) AS sunday FROM gauss),
    holidays AS (SELECT CAST(y AS INTEGER) AS year, CAST(make_date(y, m, n) AS DATE) AS day FROM years,
                        (VALUES (1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25)) AS f(m, n)
                 UNION SELECT CAST(y AS INTEGER), CAST(sunday + n AS DATE) FROM easter, (VALUES (1), (39), (50)) AS g(n))"""

OPEN_SQL = "open_days AS (SELECT day FROM span WHERE isodow(day) < 6 AND day NOT IN (SELECT day FROM holidays))"
CALENDAR_WITH = f"WITH {SPAN_SQL}, {HOLIDAYS_SQL}, {OPEN_SQL}"


def span(t: Tables) -> DataFrame:
    return op.days_between(op.observed_span(t.lineitem, "l_shipdate"))


@query("c1_days", f"WITH {SPAN_SQL} SELECT * FROM span")
def _(t: Tables):
    return span(t)


@query("c2_holidays", f"{CALENDAR_WITH} SELECT * FROM holidays")
def _(t: Tables):
    return op.public_holidays(span(t).select(F.year("day").alias("year")))


@query("c3_business_days", f"{CALENDAR_WITH} SELECT * FROM open_days")
def _(t: Tables):
    return op.business_days(span(t))


@query("c3_weekdays", f"WITH {SPAN_SQL} SELECT day FROM span WHERE isodow(day) < 6")
def _(t: Tables):
    return op.business_days(span(t), exclude_holidays=False)


@query(
    "c4_next_business_day",
    f"""WITH {SPAN_SQL}, ahead AS (SELECT DISTINCT CAST(day + CAST(n AS INTEGER) AS DATE) AS day FROM span, range(0, 15) AS r(n)),
        {HOLIDAYS_SQL.replace("FROM span", "FROM ahead")}, open_days AS (SELECT day FROM ahead WHERE isodow(day) < 6 AND day NOT IN (SELECT day FROM holidays))
        SELECT span.day, min(open_days.day) AS business_day FROM span JOIN open_days ON open_days.day BETWEEN span.day AND span.day + 14
        GROUP BY span.day""",
)
def _(t: Tables):
    return op.next_business_day(span(t))


CLOSED_SQL = """closed AS (SELECT CAST(first + CAST(n AS INTEGER) AS DATE) AS day FROM (SELECT min(CAST(l_shipdate AS DATE)) AS first FROM lineitem), range(300, 340) AS r(n)
                       UNION SELECT CAST(last - CAST(n AS INTEGER) AS DATE) FROM (SELECT max(CAST(l_shipdate AS DATE)) AS last FROM lineitem), range(-30, 20) AS r(n))"""


@query(
    "c4_long_closure",
    f"""WITH {SPAN_SQL}, {CLOSED_SQL}, ahead AS (SELECT DISTINCT CAST(day + CAST(n AS INTEGER) AS DATE) AS day FROM span, range(0, 100) AS r(n)),
        {HOLIDAYS_SQL.replace("FROM span", "FROM ahead")},
        open_days AS (SELECT day FROM ahead WHERE isodow(day) < 6 AND day NOT IN (SELECT day FROM holidays) AND day NOT IN (SELECT day FROM closed))
        SELECT span.day, min(open_days.day) AS business_day FROM span JOIN open_days ON open_days.day >= span.day GROUP BY span.day""",
)
def _(t: Tables):
    """Closures of 40 days in the span and of 50 days over its end: the next open day lies far behind."""
    seen = op.observed_span(t.lineitem, "l_shipdate")
    inside = op.days_between(seen.select(F.date_add("first_day", 300).alias("first_day"), F.date_add("first_day", 339).alias("last_day")))
    over = op.days_between(seen.select(F.date_add("last_day", -19).alias("first_day"), F.date_add("last_day", 30).alias("last_day")))
    return op.next_business_day(span(t), closures=inside.unionByName(over))


def ship_log(t: Tables) -> DataFrame:
    journal = {"src_lineitem": (t.lineitem.where("l_quantity >= 48"), "l_shipdate")}
    return bronze.run_log_rows(journal, F.lit(LOAD_TIME).cast("timestamp_ntz"))


@query(
    "c5_days_to_process",
    f"{CALENDAR_WITH} SELECT * FROM open_days WHERE day NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_quantity >= 48)",
)
def _(t: Tables):
    return op.days_to_process(span(t), ship_log(t))


@query("c5_days_forced", f"{CALENDAR_WITH} SELECT * FROM open_days")
def _(t: Tables):
    return op.days_to_process(span(t), ship_log(t), force=True)


@query(
    "c6_run_log_counts",
    f"""SELECT CAST(ts AS DATE) AS date_cible, 'src_events' AS table_cible, count(*) AS nb_versions,
               TIMESTAMP '{LOAD_TIME}' AS run_timestamp, 'append' AS run_mode FROM events GROUP BY ALL
        UNION ALL SELECT CAST(o_orderdate AS DATE), 'src_orders', count(*), TIMESTAMP '{LOAD_TIME}', 'append' FROM orders GROUP BY ALL""",
)
def _(t: Tables):
    journal = {"src_events": (t.events, "ts"), "src_orders": (t.orders, "o_orderdate")}
    return bronze.run_log_rows(journal, F.lit(LOAD_TIME).cast("timestamp_ntz"))


# Sources and sinks

# One file per region, nation, status of orders and kind of event: several share a header.
LANDED = {"nation": None, "region": None, "supplier": "s_nationkey", "orders": "o_orderstatus", "events": "event_type"}


def _landing(t: Tables) -> str:
    """Tables as single header files, some split by a column into one file per value."""
    folder = scratch_path(t.spark, "landing")
    for name, split in LANDED.items():
        df = getattr(t, name)
        texts = df.select(*fn.source_text(df))
        if split is None:
            texts.coalesce(1).write.option("header", True).csv(f"{folder}/{name}")
        else:
            texts.withColumn("part", F.col(split)).repartition("part").write.partitionBy("part").option("header", True).csv(f"{folder}/{name}")
    return _named_files(t.spark, folder)


def _named_files(spark, folder: str) -> str:
    """Give every written file the name of its table, as a source delivers it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files = store.listFiles(place, True)
    found = []
    while files.hasNext():
        path = files.next().getPath()
        if path.getName().startswith("part-"):
            found.append(path)
    for path in found:
        parent = path.getParent()
        part = parent.getName().removeprefix("part=") if parent.getName().startswith("part=") else None
        table = parent.getParent().getName() if part is not None else parent.getName()
        name = table if part is None else f"{table}_{part}"
        store.rename(path, spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.csv"))
    return folder


NAMES_SQL = """SELECT 'nation' AS table_name UNION ALL SELECT 'region' UNION ALL SELECT DISTINCT 'supplier_' || s_nationkey FROM supplier
    UNION ALL SELECT DISTINCT 'orders_' || o_orderstatus FROM orders UNION ALL SELECT DISTINCT 'events_' || event_type FROM events"""


@query("s1_list_files", NAMES_SQL)
def _(t: Tables):
    return ingest.list_files(t.spark, _landing(t), "*.csv").select("table_name")


def _row_sql(table: str, label: str, columns: list[str]) -> str:
    cells = " || '|' || ".join(f"coalesce({c}, '')" for c in columns)
    return f"SELECT {label} AS table_name, {cells} AS cells FROM {table}"


@query(
    "s2_ingest_folder",
    " UNION ALL ".join(
        (
            _row_sql("nation", "'nation'", ["CAST(n_nationkey AS VARCHAR)", "n_name", "CAST(n_regionkey AS VARCHAR)"]),
            _row_sql("region", "'region'", ["CAST(r_regionkey AS VARCHAR)", "r_name"]),
            _row_sql("supplier", "'supplier_' || s_nationkey", ["CAST(s_suppkey AS VARCHAR)", "s_name", "CAST(s_nationkey AS VARCHAR)", "printf('%.2f', s_acctbal)"]),
            _row_sql(
                "orders",
                "'orders_' || o_orderstatus",
                ["CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus", "printf('%.2f', o_totalprice)", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "o_orderpriority"],
            ),
            _row_sql(
                "events",
                "'events_' || event_type",
                ["CAST(event_id AS VARCHAR)", "strftime(ts, '%Y-%m-%d %H:%M:%S')", "CAST(user_id AS VARCHAR)", "event_type", "printf('%.2f', value)", "props"],
            ),
        )
    ),
)
def _(t: Tables):
    """All columns of every landed file, from a landing of files with five different headers."""
    folder, target = _landing(t), scratch_path(t.spark, "ingested")
    frames = []
    for table in ingest.ingest_folder(t.spark, folder, target):
        df = t.spark.read.parquet(f"{target}/{table}")
        cells = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in df.columns])
        frames.append(df.select(F.lit(table).alias("table_name"), cells.alias("cells")))
    return op.setops.union_all(frames)


@query(
    "s5_bronze_append",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, printf('%.2f', value) AS value, CAST(ts AS DATE) AS day FROM events""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "src_events")
    batch = t.events.select(*fn.source_text(t.events.select("event_id", "event_type", "value")), F.col("ts").cast("date").alias("day"))
    bronze.append_versions(batch, path, day="day", batch_id="1")
    bronze.append_versions(batch, path, day="day", batch_id="1")
    return bronze.read_versions(t.spark, path).drop("batch_id")


@query(
    "s5_append_two_batches",
    """SELECT event_id, event_type, CASE WHEN event_type IN ('view', 'click') THEN user_id END AS user_id, CAST(ts AS DATE) AS day,
              CASE WHEN event_type IN ('view', 'click') THEN 'late' ELSE 'first' END AS batch_id FROM events""",
)
def _(t: Tables):
    """Two batches of the same days are both kept, a rerun adds nothing, and a new column appears."""
    path = scratch_path(t.spark, "src_events")
    rows = t.events.select("event_id", "event_type", "user_id", F.col("ts").cast("date").alias("day"))
    late = rows.where(F.col("event_type").isin("view", "click"))
    first = rows.where(~F.col("event_type").isin("view", "click")).drop("user_id")
    for batch, name in ((first, "first"), (late, "late"), (late, "late"), (first, "first")):
        bronze.append_versions(batch, path, day="day", batch_id=name)
    contract = "event_id long, event_type string, user_id long, day date, batch_id string"
    return bronze.read_versions(t.spark, path, contract)


@query(
    "s6_full_refresh",
    "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL",
)
def _(t: Tables):
    layout = Layout(scratch_path(t.spark, "warehouse"), "test")
    layout.save("gold", "flags", t.lineitem.groupBy("l_returnflag").agg(F.lit(0).cast("long").alias("n")))
    return layout.save("gold", "flags", t.lineitem.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")))


@query("w5_sorted_output", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS position FROM orders")
def _(t: Tables):
    """Where each order lies in the stored files; a fifth of all rows share the leading value."""
    path = scratch_path(t.spark, "sorted")
    order = [F.col(c) for c in ("o_orderpriority", "o_orderdate", "o_orderkey")]
    ordered.write_sorted(t.orders, order, path, files=16)
    return ordered.positions(t.spark, path).select("o_orderkey", F.col(ordered.POSITION).alias("position"))


@query(
    "w5_boundaries",
    """SELECT count(*) AS n_rows, 0 AS n_out_of_order, 0 AS n_bad_boundaries, min(o_totalprice) AS first_price, max(o_totalprice) AS last_price
       FROM orders""",
)
def _(t: Tables):
    """Every file in order, and every file's first row not before the last one of the file before."""
    path = scratch_path(t.spark, "sorted")
    ordered.write_sorted(t.orders, [F.col("o_totalprice"), F.col("o_orderkey")], path, files=16)
    found = ordered.boundaries(t.spark, path, ["o_totalprice", "o_orderkey"])
    return found.agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_out_of_order").cast("int").alias("n_out_of_order"),
        F.count_if(~F.col("follows")).cast("int").alias("n_bad_boundaries"),
        F.min("first.o_totalprice").alias("first_price"),
        F.max("last.o_totalprice").alias("last_price"),
    )


@query(
    "s7_run_log_append",
    f"""SELECT CAST(ts AS DATE) AS date_cible, 'src_' || event_type AS table_cible, count(*) AS nb_versions,
               TIMESTAMP '{LOAD_TIME}' AS run_timestamp, 'append' AS run_mode FROM events GROUP BY ALL""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "run_log")
    stamp = F.lit(LOAD_TIME).cast("timestamp_ntz")
    rows = t.events.groupBy(F.col("ts").cast("date").alias("date_cible"), F.concat(F.lit("src_"), "event_type").alias("table_cible"))
    counted = rows.agg(F.count(F.lit(1)).alias("nb_versions")).withColumns({"run_timestamp": stamp, "run_mode": F.lit("append")})
    halves = {"early": F.col("date_cible") < "2024-01-15", "late": F.col("date_cible") >= "2024-01-15"}
    for name in ("early", "late", "late"):  # a rerun adds nothing
        bronze.append_run_log(counted.where(halves[name]), path, batch_id=name)
    return bronze.read_run_log(t.spark, path)


@query(
    "s9_dry_run",
    """SELECT 'customer' AS table_cible, count(*) AS nb_versions FROM customer UNION ALL SELECT 'events', count(*) FROM events
       UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
)
def _(t: Tables):
    return bronze.batch_counts({"customer": t.customer, "events": t.events, "lineitem": t.lineitem})


# Entity operators

SALE_TEXT = {
    "vente_id": "cast(o_orderkey as string)",
    "statut_vente": "case o_orderstatus when 'F' then 'LIVREE' else 'SIGNEE' end",
    "date_livraison_reelle": "cast(o_orderdate as date)",
}


@query(
    "b10_resale_candidates",
    """SELECT CAST(o_orderkey AS VARCHAR) AS vente_id, CAST(o_orderdate AS DATE) AS date_livraison_reelle FROM orders
       WHERE o_orderstatus = 'F' AND DATE '2001-08-01' - CAST(o_orderdate AS DATE) > 730
         AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def _(t: Tables):
    sales = t.orders.select(*[F.expr(text).alias(name) for name, text in SALE_TEXT.items()])
    resales = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").cast("string").alias("vente_id"))
    as_of = F.lit(date(2001, 8, 1))
    return op.resale_candidates(sales, resales, as_of).select("vente_id", "date_livraison_reelle")


@query(
    "b11_eligible_pool",
    """SELECT 'P' AS tag, CAST(c_custkey AS VARCHAR) AS member_id FROM customer WHERE c_mktsegment <> 'BUILDING'
       UNION ALL SELECT DISTINCT 'I', CAST(o_custkey AS VARCHAR) FROM orders""",
)
def _(t: Tables):
    prospects = t.customer.where("c_mktsegment <> 'BUILDING'")
    return op.tagged_pool({"P": (prospects, "c_custkey"), "I": (t.orders, "o_custkey")})


@query(
    "b12_same_region",
    """WITH city AS (SELECT n_name AS ville, CAST(n_regionkey AS VARCHAR) AS region_id, n_nationkey FROM nation),
            lots AS (SELECT l_partkey AS programme, l_orderkey || '-' || l_linenumber AS lot_id FROM lineitem WHERE l_returnflag = 'A'),
            programmes AS (SELECT p_partkey AS programme, region_id FROM part JOIN city ON p_partkey % 25 = n_nationkey),
            per_region AS (SELECT region_id, count(*) AS available_lots, min(lot_id) AS first_lot FROM lots JOIN programmes USING (programme) GROUP BY ALL)
       SELECT CAST(c_custkey AS VARCHAR) AS investisseur_id, region_id, coalesce(available_lots, 0) AS available_lots, first_lot
       FROM customer JOIN city ON c_nationkey = n_nationkey LEFT JOIN per_region USING (region_id)""",
)
def _(t: Tables):
    names = t.nation.select("n_nationkey", F.col("n_name").alias("ville"), F.col("n_regionkey").cast("string").alias("region_id"))
    city = names.select("n_nationkey", "ville")
    investors = t.customer.join(city, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("investisseur_id"), "ville"
    )
    programmes = t.part.join(city, F.col("p_partkey") % 25 == F.col("n_nationkey")).select(
        F.col("p_partkey").alias("programme_id"), "ville"
    )
    lots = t.lineitem.select(
        F.col("l_partkey").alias("programme_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("lot_id"),
        F.when(F.col("l_returnflag") == "A", "DISPONIBLE").otherwise("VENDU").alias("statut_lot"),
    )
    return op.same_region(investors, lots, programmes, names)


@query(
    "b12_all_investors",
    """WITH city AS (SELECT n_name AS ville, CAST(n_regionkey AS VARCHAR) AS region_id, n_nationkey FROM nation),
            lots AS (SELECT n_regionkey, count(*) AS n, min(l_orderkey) AS first_lot FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                     JOIN nation ON s_nationkey = n_nationkey WHERE l_returnflag = 'A' AND n_regionkey < 3 GROUP BY ALL)
       SELECT CAST(c_custkey AS VARCHAR) AS investisseur_id, CASE WHEN region_id < '3' THEN region_id END AS region_id,
              coalesce(n, 0) AS available_lots, first_lot
       FROM customer JOIN city ON c_nationkey = n_nationkey LEFT JOIN lots ON CAST(n_regionkey AS VARCHAR) = region_id""",
)
def _(t: Tables):
    """Cities of two regions have no agency; their investors stay, without region and lots."""
    city = t.nation.select("n_nationkey", F.col("n_name").alias("ville"), F.col("n_regionkey").cast("string").alias("region_id"))
    investors = t.customer.join(city, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("investisseur_id"), "ville")
    programmes = t.supplier.join(city, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("programme_id"), "ville")
    lots = t.lineitem.select(
        F.col("l_suppkey").alias("programme_id"), F.col("l_orderkey").alias("lot_id"), F.when(F.col("l_returnflag") == "A", "DISPONIBLE").alias("statut_lot")
    )
    return op.same_region(investors, lots, programmes, city.where("region_id < '3'").select("ville", "region_id"))


@query(
    "b13_last_attributes",
    """SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY ALL""",
)
def _(t: Tables):
    return op.last_attributes(t.events, "user_id", ["ts", "event_id"], ["event_type", "value"])


TRANSITIONS_SQL = """SELECT from_status, to_status, count(*) AS n_moves,
           CAST(sum(s) AS DOUBLE) / nullif(count(s), 0) / 86400 AS mean_days
    FROM (SELECT lag({status}) OVER w AS from_status, {status} AS to_status, lag(1) OVER w AS had_one,
                 CAST(floor(epoch({clock})) AS BIGINT) - CAST(floor(epoch(lag({clock}) OVER w)) AS BIGINT) AS s
          FROM {table} WHERE {key} IS NOT NULL WINDOW w AS (PARTITION BY {key} ORDER BY {order}))
    WHERE had_one IS NOT NULL GROUP BY ALL"""


@query(
    "b14_transitions",
    TRANSITIONS_SQL.format(table="events", key="user_id", status="event_type", clock="ts", order="ts, event_id"),
)
def _(t: Tables):
    return op.status_transitions(t.events, "user_id", "event_type", ["ts", "event_id"])


@query(
    "b14_transitions_skewed",
    TRANSITIONS_SQL.format(
        table="(SELECT *, CASE WHEN event_type IN ('view', 'click') THEN -1 ELSE user_id END AS entity FROM events)",
        key="entity",
        status="event_type",
        clock="ts",
        order="ts, event_id",
    ),
)
def _(t: Tables):
    hot = F.when(F.col("event_type").isin("view", "click"), -1).otherwise(F.col("user_id"))
    return op.status_transitions(t.events.withColumn("entity", hot), "entity", "event_type", ["ts", "event_id"], range_rows=1000)


@query(
    "b14_transitions_null_times",
    TRANSITIONS_SQL.format(
        table="""(SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_type = 'view' THEN TIMESTAMP '2024-01-01 00:00:00' ELSE ts END AS moment,
                         nullif(event_type, 'error') AS state, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS entity FROM events)""",
        key="entity",
        status="state",
        clock="moment",
        order="moment NULLS FIRST, event_id",
    ),
)
def _(t: Tables):
    """A third of all versions on one key, many at one instant, a fifth without a time, some without a status."""
    rows = t.events.select(
        "event_id",
        F.expr("case when event_id % 5 = 0 then null when event_type = 'view' then timestamp_ntz '2024-01-01 00:00:00' else ts end").alias("moment"),
        F.expr("nullif(event_type, 'error')").alias("state"),
        F.expr("case when event_id % 3 = 0 then -1 else user_id end").alias("entity"),
    )
    return op.status_transitions(rows, "entity", "state", ["moment", "event_id"], range_rows=1000)
