"""A small star over the given tables: the same specs and builders as the full model.

Orders reach it as all-text versions. Some have no customer, some a customer that does
not exist, and some are deleted, so every branch of the lookups is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratastar.examples.registry import Tables
from stratastar.functions import date_key, surrogate_key
from stratastar.functions.keys import unknown_key
from stratastar.operators import Lookup, domain_values, observed_dates
from stratastar.plans.gold import dimension, fact
from stratastar.plans.semantic import Measure, Model, Relationship, measure_query, needed
from stratastar.plans.silver import silver_table
from stratastar.plans.specs import DimensionSpec, FactSpec, SilverSpec
from stratastar.session import dealt, materialise_all

ORDER_TEXT = {
    "order_id": "cast(o_orderkey as string)",
    "customer_id": "case o_orderpriority when '5-LOW' then null when '1-URGENT' then concat('X', cast(o_custkey as string)) "
    "else cast(o_custkey as string) end",
    "date_order": "cast(cast(o_orderdate as date) as string)",
    "status": "case when o_orderpriority = '2-HIGH' then null else concat(' ', lower(o_orderstatus), ' ') end",
    "amount": "cast(cast(o_totalprice as decimal(18,2)) as string)",
    "is_deleted": "case when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'P' then 'oui' else 'non' end",
    "updated_at": "concat(cast(cast(o_orderdate as date) as string), ' 08:00:00')",
}

ORDERS = SilverSpec(
    "orders",
    "order_id",
    {
        "order_id": "id",
        "customer_id": "id",
        "date_order": "date",
        "status": "code",
        "amount": "18,2",
        "is_deleted": "flag",
        "updated_at": "timestamp",
    },
    version_order=("updated_at",),
    deleted="is_deleted",
)

LINE_TEXT = {
    "line_id": "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))",
    "part_id": "cast(l_partkey as string)",
    "supplier_id": "case when l_returnflag = 'R' then concat('X', cast(l_suppkey as string)) else cast(l_suppkey as string) end",
    "date_ship": "cast(cast(l_shipdate as date) as string)",
    "status": "l_linestatus",
    "amount": "cast(cast(l_extendedprice as decimal(18,2)) as string)",
    "quantity": "cast(cast(l_quantity as int) as string)",
    "is_deleted": "'0'",
    "updated_at": "concat(cast(cast(l_shipdate as date) as string), ' 08:00:00')",
}

LINES = SilverSpec(
    "lines",
    "line_id",
    {
        "line_id": "id",
        "part_id": "id",
        "supplier_id": "id",
        "date_ship": "date",
        "status": "code",
        "amount": "18,2",
        "quantity": "int",
        "is_deleted": "flag",
        "updated_at": "timestamp",
    },
    version_order=("updated_at",),
    deleted="is_deleted",
)

REGION = DimensionSpec("dim_region", "region", "r_regionkey", "region_key", unknown={"r_name": "Region inconnue"})
NATION = DimensionSpec(
    "dim_nation",
    "nation",
    "n_nationkey",
    "nation_key",
    parents=(Lookup("dim_region", "n_regionkey", "r_regionkey", "region_key"),),
    unknown={"n_name": "Nation inconnue"},
)
CUSTOMER = DimensionSpec(
    "dim_customer",
    "customer",
    "c_custkey",
    "customer_key",
    parents=(Lookup("dim_nation", "c_nationkey", "n_nationkey", "nation_key"),),
    unknown={"c_name": "Client inconnu", "c_mktsegment": "INCONNU"},
)
SUPPLIER = DimensionSpec(
    "dim_supplier",
    "supplier",
    "s_suppkey",
    "supplier_key",
    parents=(Lookup("dim_nation", "s_nationkey", "n_nationkey", "nation_key"),),
    unknown={"s_name": "Fournisseur inconnu"},
)
PART = DimensionSpec(
    "dim_part", "part", "p_partkey", "part_key", unknown={"p_name": "Produit inconnu", "p_type": "INCONNU"}
)

FACT_ORDER = FactSpec(
    "fact_order",
    "orders",
    "order_id",
    "order_key",
    (Lookup("dim_customer", "customer_id", "c_custkey", "customer_key"),),
    "date_order_key",
    ("ORDER", "status"),
)
FACT_LINE = FactSpec(
    "fact_line",
    "lines",
    "line_id",
    "line_key",
    (
        Lookup("dim_part", "part_id", "p_partkey", "part_key"),
        Lookup("dim_supplier", "supplier_id", "s_suppkey", "supplier_key"),
    ),
    "date_ship_key",
    ("LINE", "status"),
)


def bronze_orders(t: Tables) -> DataFrame:
    return dealt(t.orders).select(*[F.expr(text).alias(name) for name, text in ORDER_TEXT.items()])


def bronze_lines(t: Tables) -> DataFrame:
    return dealt(t.lineitem).select(*[F.expr(text).alias(name) for name, text in LINE_TEXT.items()])


def silver_orders(t: Tables) -> DataFrame:
    return silver_table(bronze_orders(t), ORDERS)


def silver_lines(t: Tables) -> DataFrame:
    return silver_table(bronze_lines(t), LINES)


def reference_table(t: Tables, name: str) -> DataFrame:
    """A master table with its keys as text."""
    df = getattr(t, name)
    return df.withColumns({c: F.col(c).cast("string") for c in df.columns if c.endswith("key")})


MASTERS = {spec.name: spec for spec in (REGION, NATION, CUSTOMER, SUPPLIER, PART)}


def master_dimension(t: Tables, name: str) -> DataFrame:
    """One dimension with its parents inside its own plan."""
    spec = MASTERS[name]
    parents = {p.dimension: master_dimension(t, p.dimension) for p in spec.parents}
    return dimension(reference_table(t, spec.source), spec, parents, latest=False)


def dim_status(t: Tables) -> DataFrame:
    return domain_values(
        {
            "ORDER": (t.orders, "o_orderstatus"),
            "PRIORITY": (t.orders, "o_orderpriority"),
            "LINE": (t.lineitem, "l_linestatus"),
            "EVENT": (t.events, "event_type"),
        }
    )


def dim_date(t: Tables) -> DataFrame:
    month = F.trunc("o_orderdate", "month")
    return observed_dates([(t.orders, ["o_orderdate", month]), (t.lineitem, ["l_shipdate"])])


def fact_target(t: Tables) -> DataFrame:
    """Monthly target per status: a tenth more than the orders of that month, at a coarser grain than orders."""
    month = F.trunc("o_orderdate", "month")
    return (
        t.orders.groupBy(date_key(month).alias("date_target_key"), "o_orderstatus")
        .agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")) * F.lit("1.1").cast("decimal(2,1)")).alias("target"))
        .select(
            "date_target_key",
            surrogate_key(F.lit("ORDER"), "o_orderstatus").alias("statut_key"),
            F.col("target").cast("decimal(38,3)").alias("target"),
        )
    )


MEASURES = (
    Measure("revenue", "sum", "fact_order", "amount"),
    Measure("n_orders", "count", "fact_order"),
    Measure("n_unknown_customer", "count", "fact_order", where=lambda: F.col("customer_key") == unknown_key(), reads=("customer_key",)),
    Measure("mean_order", "avg", "fact_order", "amount"),
    Measure("shipped", "sum", "fact_line", "amount"),
    Measure("n_lines", "count", "fact_line"),
    Measure("target", "sum", "fact_target", "target"),
    Measure("n_customers", "distinct", "dim_customer", "customer_key"),
    Measure("mean_balance", "avg", "dim_customer", "balance"),
    Measure("attainment", "ratio", numerator="revenue", denominator="target"),
    Measure("order_value", "ratio", numerator="revenue", denominator="n_orders"),
)


EDGES = (
    Relationship("fact_order", "customer_key", "dim_customer", "customer_key"),
    Relationship("fact_order", "date_order_key", "dim_date", "date_key"),
    Relationship("fact_order", "statut_key", "dim_statut", "statut_key"),
    Relationship("fact_line", "part_key", "dim_part", "part_key"),
    Relationship("fact_line", "supplier_key", "dim_supplier", "supplier_key"),
    Relationship("fact_line", "date_ship_key", "dim_date", "date_key"),
    Relationship("fact_line", "statut_key", "dim_statut", "statut_key"),
    Relationship("fact_target", "date_target_key", "dim_date", "date_key"),
    Relationship("fact_target", "statut_key", "dim_statut", "statut_key"),
)


FACTS = {spec.name: spec for spec in (FACT_ORDER, FACT_LINE)}
SILVER = {"fact_order": silver_orders, "fact_line": silver_lines}


def retail_model(t: Tables, *facts: str, reads: dict[str, set[str]] | None = None) -> Model:
    """The facts with what they look up, or with `reads` (columns by table) only what is read of
    them. Looked-up tables are stored once for all their consumers; the date dimension only meets
    summed-up rows and stays a plan."""
    specs = [FACTS[name] for name in facts if name in FACTS]
    only = {spec.name: None if reads is None else reads.get(spec.name, set()) for spec in specs}
    read = lambda spec, key: only[spec.name] is None or key in only[spec.name]
    masters = dict.fromkeys(target.dimension for spec in specs for target in spec.lookups if read(spec, target.key))
    masters |= dict.fromkeys(name for name in facts if name in MASTERS)
    domains = [spec.status[0] for spec in specs if spec.status and read(spec, "statut_key")]
    stored = {name: master_dimension(t, name) for name in masters}
    if domains:
        stored["dim_statut"] = dim_status(t).where(F.col("domaine_statut").isin(domains))
    tables = materialise_all(stored)
    for spec in specs:
        tables[spec.name] = fact(SILVER[spec.name](t), spec, tables, only[spec.name], unique=True)
    if "fact_target" in facts:
        tables["fact_target"] = fact_target(t)
    if "dim_customer" in tables:
        tables["dim_customer"] = tables["dim_customer"].withColumn("balance", F.col("c_acctbal").cast("decimal(18,2)"))
    tables["dim_date"] = dim_date(t)
    return Model(tables, EDGES, {m.name: m for m in MEASURES})


def measured(t: Tables, names: list[str], by: list[tuple[str, str]]) -> DataFrame:
    """The measures by (dimension, column), over a model that holds only what they read."""
    measures = {m.name: m for m in MEASURES}
    dimensions = [dimension for dimension, _ in by]
    reads = needed(EDGES, measures, names, dimensions)
    return measure_query(retail_model(t, *reads, *[d for d in dimensions if d in MASTERS], reads=reads), names, by)


# The same star in SQL.

_UNKNOWN = "sha256('__UNKNOWN__')"


SILVER_ORDERS_SQL = f"""silver_orders AS (
    SELECT {ORDER_TEXT["order_id"]} AS order_id, {ORDER_TEXT["customer_id"]} AS customer_id,
           CAST(o_orderdate AS DATE) AS date_order, upper(trim({ORDER_TEXT["status"]})) AS status,
           CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' AS is_deleted,
           CAST({ORDER_TEXT["updated_at"]} AS TIMESTAMP) AS updated_at
    FROM orders)"""

SILVER_LINES_SQL = f"""silver_lines AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY updated_at DESC, part_id, supplier_id, date_ship, status,
                                     amount, quantity, is_deleted) AS rn
        FROM (SELECT {LINE_TEXT["line_id"]} AS line_id, {LINE_TEXT["part_id"]} AS part_id,
                     {LINE_TEXT["supplier_id"]} AS supplier_id, CAST(l_shipdate AS DATE) AS date_ship,
                     l_linestatus AS status, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
                     CAST(l_quantity AS INTEGER) AS quantity, false AS is_deleted,
                     CAST({LINE_TEXT["updated_at"]} AS TIMESTAMP) AS updated_at
              FROM lineitem)) WHERE rn = 1)"""

DIM_STATUS_SQL = """dim_statut AS (
    SELECT sha256(domaine_statut || '-' || statut_value) AS statut_key, domaine_statut, statut_value FROM (
        SELECT 'ORDER' AS domaine_statut, upper(trim(o_orderstatus)) AS statut_value FROM orders
        UNION SELECT 'PRIORITY', upper(trim(o_orderpriority)) FROM orders
        UNION SELECT 'LINE', upper(trim(l_linestatus)) FROM lineitem
        UNION SELECT 'EVENT', upper(trim(event_type)) FROM events
        UNION SELECT unnest(['ORDER', 'PRIORITY', 'LINE', 'EVENT']), '__UNKNOWN__'))"""

DIM_CUSTOMER_SQL = f"""dim_customer AS (
    SELECT sha256(CAST(c_custkey AS VARCHAR)) AS customer_key, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
           CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, c_mktsegment,
           coalesce((SELECT sha256(CAST(n_nationkey AS VARCHAR)) FROM nation WHERE n_nationkey = c_nationkey), {_UNKNOWN}) AS nation_key
    FROM customer
    UNION ALL SELECT {_UNKNOWN}, '__UNKNOWN__', 'Client inconnu', '__UNKNOWN__', NULL, 'INCONNU', {_UNKNOWN})"""

FACT_ORDER_SQL = f"""fact_order AS (
    SELECT sha256(order_id) AS order_key, order_id, o.customer_id, o.status, o.amount, o.updated_at,
           CAST(strftime(o.date_order, '%Y%m%d') AS INTEGER) AS date_order_key,
           CASE WHEN EXISTS (SELECT 1 FROM customer WHERE CAST(c_custkey AS VARCHAR) = o.customer_id)
                THEN sha256(o.customer_id) ELSE {_UNKNOWN} END AS customer_key,
           CASE WHEN o.status IN (SELECT statut_value FROM dim_statut WHERE domaine_statut = 'ORDER')
                THEN sha256('ORDER-' || o.status) ELSE sha256('ORDER-__UNKNOWN__') END AS statut_key
    FROM silver_orders o WHERE NOT is_deleted)"""

FACT_LINE_SQL = f"""fact_line AS (
    SELECT sha256(line_id) AS line_key, line_id, l.part_id, l.supplier_id, l.status, l.amount, l.quantity, l.updated_at,
           CAST(strftime(l.date_ship, '%Y%m%d') AS INTEGER) AS date_ship_key,
           CASE WHEN EXISTS (SELECT 1 FROM part WHERE CAST(p_partkey AS VARCHAR) = l.part_id)
                THEN sha256(l.part_id) ELSE {_UNKNOWN} END AS part_key,
           CASE WHEN EXISTS (SELECT 1 FROM supplier WHERE CAST(s_suppkey AS VARCHAR) = l.supplier_id)
                THEN sha256(l.supplier_id) ELSE {_UNKNOWN} END AS supplier_key,
           sha256('LINE-' || l.status) AS statut_key
    FROM silver_lines l)"""

FACT_TARGET_SQL = """fact_target AS (
    SELECT CAST(strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS INTEGER) AS date_target_key,
           sha256('ORDER-' || o_orderstatus) AS statut_key, sum(CAST(o_totalprice AS DECIMAL(18,2))) * CAST(1.1 AS DECIMAL(2,1)) AS target
    FROM orders GROUP BY ALL)"""

STAR_SQL = "WITH " + ", ".join(
    [SILVER_ORDERS_SQL, SILVER_LINES_SQL, DIM_STATUS_SQL, DIM_CUSTOMER_SQL, FACT_ORDER_SQL, FACT_LINE_SQL, FACT_TARGET_SQL]
)
