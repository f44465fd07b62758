"""Row-level security on the given tables.

Grants come from customers: five per user, with scopes from a customer's segment.
Nations play the agencies, suppliers the advisers, customers the investors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratastar.examples import retail
from stratastar.examples.registry import Tables, query
from stratastar.functions import flag
from stratastar.functions.keys import NULL_TOKEN
from stratastar.operators.setops import union_all
from stratastar.plans.security import ROLES, Role, access_table, bypasses, secured, stored_grants, user_grants, visible
from stratastar.plans.semantic import propagate
from stratastar.session import materialise_all

ACCESS_TEXT = {
    "user_access_id": "cast(c_custkey as string)",
    "user_email": "case when c_acctbal > 9950 then null when c_acctbal > 9900 then ' ' "
    "else concat(' User', cast(c_custkey % 300 as string), '@Example.com ') end",
    "user_name": "c_name",
    "role_metier": "concat(' ', lower(substr(c_mktsegment, 1, 4)), ' ')",
    "access_level": "case when c_mktsegment = 'MACHINERY' and c_acctbal > 8000 then 'all' "
    "when c_mktsegment = 'BUILDING' and c_acctbal > 8500 then ' adv' else 'Scope' end",
    "region_id": "case when c_mktsegment = 'HOUSEHOLD' and c_acctbal > 3000 then cast(c_nationkey % 5 as string) else '' end",
    "agence_id": "case when c_mktsegment = 'FURNITURE' then cast(c_nationkey as string) end",
    "conseiller_id": "case when c_mktsegment = 'AUTOMOBILE' then cast(c_custkey as string) else '' end",
    "partenaire_id": "case when c_mktsegment = 'BUILDING' then concat('P', cast(c_nationkey as string)) end",
    "can_view_commissions": "case when c_acctbal > 0 then '1' end",
    "is_active": "case when c_acctbal < 0 then 'non' when c_acctbal < 1000 then null else 'Oui' end",
    "created_at": "'2024-01-01 08:00:00'",
    "updated_at": "concat('2024-02-', case when c_acctbal > 5000 then '02' else '01' end, ' 09:00:00')",
}

_BLANK = ("region_id", "agence_id", "conseiller_id", "partenaire_id")


def _raw_access(t: Tables) -> DataFrame:
    raw = t.customer.select(*[F.expr(text).alias(name) for name, text in ACCESS_TEXT.items()])
    known = F.col("is_active").isNotNull()
    return raw.withColumns(
        {
            "can_view_commissions": F.when(F.col("can_view_commissions").isNotNull(), flag("can_view_commissions")),
            "can_view_margin": F.lit(False),
            "can_view_personal_data": F.lit(None).cast("boolean"),
            "can_export_data": F.lit(True),
            "is_active": F.when(known, flag("is_active")),
            "created_at": F.col("created_at").cast("timestamp_ntz"),
            "updated_at": F.col("updated_at").cast("timestamp_ntz"),
        }
    )


def access(t: Tables) -> DataFrame:
    return access_table(_raw_access(t))


def _part(name: str) -> str:
    return f"coalesce({name}, '{NULL_TOKEN}')"


ACCESS_SQL = f"""access AS (
    SELECT sha256({" || '-' || ".join(_part(c) for c in ("user_email", "role_metier", "access_level", *_BLANK))}) AS security_access_key,
           * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_email, role_metier, access_level, {", ".join(f"coalesce({c}, 'none')" for c in _BLANK)}
            ORDER BY updated_at DESC, created_at DESC, user_access_id) AS rn
        FROM (SELECT {ACCESS_TEXT["user_access_id"]} AS user_access_id, lower(trim({ACCESS_TEXT["user_email"]})) AS user_email,
                     c_name AS user_name, upper(trim({ACCESS_TEXT["role_metier"]})) AS role_metier,
                     upper(trim({ACCESS_TEXT["access_level"]})) AS access_level,
                     {", ".join(f"nullif({ACCESS_TEXT[c]}, '') AS {c}" for c in _BLANK)},
                     c_acctbal > 0 AS can_view_commissions, false AS can_view_margin, false AS can_view_personal_data,
                     true AS can_export_data, c_acctbal >= 0 AS is_active,
                     TIMESTAMP '2024-01-01 08:00:00' AS created_at, CAST({ACCESS_TEXT["updated_at"]} AS TIMESTAMP) AS updated_at
              FROM customer)
        WHERE user_email IS NOT NULL AND user_email <> '') WHERE rn = 1)"""


def dim_agency(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").cast("string").alias("agence_id"), F.col("n_regionkey").cast("string").alias("region_id"), "n_name"
    )


def dim_adviser(t: Tables) -> DataFrame:
    agency = dim_agency(t).select("agence_id", "region_id")
    return t.supplier.select(
        F.col("s_suppkey").cast("string").alias("conseiller_id"), F.col("s_nationkey").cast("string").alias("agence_id")
    ).join(agency, "agence_id", "left")


def dim_investor(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("investisseur_id"),
        F.col("c_nationkey").cast("string").alias("agence_id"),
        F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("partenaire_id"),
        F.col("c_custkey").cast("string").alias("conseiller_id"),
    )


AGENCY_SQL = (
    "agency AS (SELECT CAST(n_nationkey AS VARCHAR) AS agence_id, CAST(n_regionkey AS VARCHAR) AS region_id, n_name FROM nation)"
)
ADVISER_SQL = (
    "adviser AS (SELECT CAST(s_suppkey AS VARCHAR) AS conseiller_id, CAST(s_nationkey AS VARCHAR) AS agence_id, region_id "
    "FROM supplier LEFT JOIN agency ON agency.agence_id = CAST(s_nationkey AS VARCHAR))"
)
INVESTOR_SQL = (
    "investor AS (SELECT CAST(c_custkey AS VARCHAR) AS investisseur_id, CAST(c_nationkey AS VARCHAR) AS agence_id, "
    "'P' || c_nationkey AS partenaire_id, CAST(c_custkey AS VARCHAR) AS conseiller_id FROM customer)"
)


def rule_sql(table: str, columns: tuple[str, ...], email: str) -> str:
    grants = f"SELECT * FROM access WHERE user_email = '{email.lower()}' AND is_active"
    tests = " OR ".join(f"{c} IN (SELECT {c} FROM ({grants}) WHERE {c} IS NOT NULL)" for c in columns)
    return (
        f"WITH {ACCESS_SQL}, {AGENCY_SQL}, {ADVISER_SQL}, {INVESTOR_SQL} SELECT * FROM {table} "
        f"WHERE {tests} OR EXISTS (SELECT 1 FROM ({grants}) WHERE access_level IN ('ALL', 'ADV'))"
    )


# A user with scopes only, one with full access, one without any grant.
SCOPED, OPEN, STRANGER = "USER112@example.com", "user106@EXAMPLE.com", "nobody@example.com"


@query("r1_grants", f"WITH {ACCESS_SQL} SELECT * FROM access WHERE user_email = '{SCOPED.lower()}' AND is_active")
def _(t: Tables):
    return user_grants(access(t), SCOPED)


@query(
    "r2_bypass",
    f"""WITH {ACCESS_SQL} SELECT user_email, bool_or(access_level IN ('ALL', 'ADV')) AS sees_all FROM access WHERE is_active GROUP BY ALL""",
)
def _(t: Tables):
    grants = access(t).where("is_active")
    return grants.groupBy("user_email").agg(F.bool_or(F.col("access_level").isin("ALL", "ADV")).alias("sees_all"))


_RULES = {
    "r3_adviser_rule": ("adviser", dim_adviser, ROLES["RLS_conseillers"]),
    "r4_investor_rule": ("investor", dim_investor, ROLES["RLS_investisseur"]),
    "r5_agency_rule": ("agency", dim_agency, ROLES["RLS_region/agence"]),
}
for _name, (_table, _build, _role) in _RULES.items():
    for _suffix, _email in (("", SCOPED), ("_open", OPEN), ("_stranger", STRANGER)):

        @query(_name + _suffix, rule_sql(_table, _role.columns, _email))
        def _(t: Tables, build=_build, role=_role, email=_email):
            return visible(build(t), role, stored_grants(access(t), email))


def _two_roles_sql() -> str:
    """Rows seen under the adviser role alone, and under the adviser and the investor role together."""
    grants = f"SELECT * FROM access WHERE user_email = '{SCOPED.lower()}' AND is_active"
    tests = " OR ".join(f"{c} IN (SELECT {c} FROM ({grants}) WHERE {c} IS NOT NULL)" for c in ROLES["RLS_conseillers"].columns)
    return (
        f"WITH {ACCESS_SQL}, {AGENCY_SQL}, {ADVISER_SQL}, {INVESTOR_SQL} "
        f"SELECT 'one' AS roles, 'dim_conseiller' AS dimension, conseiller_id AS id FROM adviser "
        f"WHERE {tests} OR EXISTS (SELECT 1 FROM ({grants}) WHERE access_level IN ('ALL', 'ADV')) "
        "UNION ALL SELECT 'one', 'dim_investisseur', investisseur_id FROM investor "
        "UNION ALL SELECT 'two', 'dim_conseiller', conseiller_id FROM adviser "
        "UNION ALL SELECT 'two', 'dim_investisseur', investisseur_id FROM investor"
    )


@query("role_two_roles", _two_roles_sql())
def _(t: Tables):
    """Roles add up: a dimension that one of the user's roles leaves unfiltered is seen whole."""
    dimensions = {"dim_conseiller": dim_adviser(t), "dim_investisseur": dim_investor(t)}
    ids = {"dim_conseiller": "conseiller_id", "dim_investisseur": "investisseur_id"}
    allowed, parts = access(t), []
    for label, roles in (("one", ["RLS_conseillers"]), ("two", ["RLS_conseillers", "RLS_investisseur"])):
        seen = dimensions | secured(dimensions, allowed, SCOPED, [ROLES[r] for r in roles])
        parts += [df.select(F.lit(label).alias("roles"), F.lit(name).alias("dimension"), F.col(ids[name]).alias("id")) for name, df in seen.items()]
    return union_all(parts)


@query(
    "r6_secured_fact",
    f"""{retail.STAR_SQL}, {ACCESS_SQL}, grants AS (SELECT * FROM access WHERE user_email = '{SCOPED.lower()}' AND is_active)
        SELECT order_id, amount FROM fact_order WHERE customer_key IN (
            SELECT customer_key FROM dim_customer WHERE c_nationkey IN (SELECT agence_id FROM grants WHERE agence_id IS NOT NULL)
               OR 'P' || c_nationkey IN (SELECT partenaire_id FROM grants WHERE partenaire_id IS NOT NULL)
               OR EXISTS (SELECT 1 FROM grants WHERE access_level IN ('ALL', 'ADV')))""",
)
def _(t: Tables):
    model = retail.retail_model(t, "fact_order", reads={"fact_order": {"customer_key"}})
    customers = model.tables["dim_customer"].withColumns(
        {"agence_id": F.col("c_nationkey"), "partenaire_id": F.concat(F.lit("P"), F.col("c_nationkey"))}
    )
    roles = [Role("dim_customer", ("agence_id",)), Role("dim_customer", ("partenaire_id",))]
    filtered = secured({"dim_customer": customers}, access(t), SCOPED, roles)
    return propagate(model, "fact_order", materialise_all(filtered)).select("order_id", "amount")


@query("r7_access_table", f"WITH {ACCESS_SQL} SELECT * FROM access")
def _(t: Tables):
    return access(t)


@query(
    "r8_bypass_flag",
    f"""WITH {ACCESS_SQL} SELECT r_regionkey, EXISTS (SELECT 1 FROM access WHERE user_email = '{OPEN.lower()}' AND is_active
            AND access_level IN ('ALL', 'ADV')) AS sees_all FROM region""",
)
def _(t: Tables):
    return t.region.select("r_regionkey", bypasses(user_grants(access(t), OPEN)).alias("sees_all"))
