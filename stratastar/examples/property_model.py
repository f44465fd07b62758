"""The full property-investment model, from source versions to measures.

Every source table reads the real columns of a given table: dates, money, statuses, texts and
whole numbers by kind, and its keys and foreign keys, so references grow with the tables. The
texts get the faults that sources have, by the number of the row: unreadable values, missing and
orphaned keys, deleted rows, several versions per key, and one client and one agency that hold a
third of all references. Both engines read the same expressions. Master tables have no dates;
theirs follow from the row number.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratastar.examples.columns import CALENDAR_SQL, LOAD_TIME, RATE_SQL
from stratastar.examples.registry import Tables, query
from stratastar.functions.keys import NULL_TOKEN
from stratastar.operators import domain_values, freshness, observed_dates, quality_log
from stratastar.plans import catalogue, pipeline
from stratastar.plans.gold import dimension, fact, read_by_dimension, read_by_fact
from stratastar.plans.security import ROLES, access_table, stored_grants, visible
from stratastar.plans.semantic import measure_query, needed
from stratastar.plans.silver import silver_columns, silver_table
from stratastar.session import TASK_ROWS, dealt, materialise, materialise_all

# Source table: (given table, versions per key).
ORIGINS = {
    "agences_regions": ("supplier", 4),
    "conseillers": ("supplier", 2),
    "partenaires_patrimoine": ("customer", 5),
    "produits_investissement": ("part", 10),
    "programmes_immobiliers": ("part", 4),
    "lots_immobiliers": ("orders", 3),
    "crm_investisseurs": ("customer", 2),
    "crm_prospects": ("customer", 2),
    "security_user_access": ("customer", 1),
    "objectifs_commerciaux": ("orders", 4),
    "evenements_clients": ("events", 1),
    "ventes_immobilieres": ("lineitem", 2),
    "commissions": ("lineitem", 2),
    "financements": ("lineitem", 2),
    "gestion_locative": ("lineitem", 2),
    "reservations_immobilieres": ("orders", 2),
    "souscriptions_pierre_papier": ("orders", 2),
    "revente_biens": ("orders", 2),
    "expertise_comptable_lmnp": ("orders", 2),
    "operations_crowdfunding": ("events", 2),
    "dossiers_adv": ("events", 2),
    "reclamations_incidents": ("events", 2),
}

# Row number, and the column that gives each kind of value, by given table.
ROWS = {
    "supplier": "s_suppkey",
    "customer": "c_custkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey * 8 + l_linenumber",
    "events": "event_id",
}
VALUES = {
    "supplier": {"money": "s_acctbal", "code": "s_name", "text": "s_name", "int": "s_nationkey"},
    "customer": {"money": "c_acctbal", "code": "c_mktsegment", "text": "c_name", "int": "c_nationkey"},
    "part": {"money": "p_retailprice", "code": "p_brand", "text": "p_name", "int": "p_size"},
    "orders": {"date": "o_orderdate", "money": "o_totalprice", "code": "o_orderstatus", "text": "o_orderpriority", "int": "o_custkey"},
    "lineitem": {"date": "l_shipdate", "money": "l_extendedprice", "code": "l_linestatus", "text": "l_returnflag", "int": "l_quantity", "rate": "l_discount"},
    "events": {"date": "ts", "money": "value", "code": "event_type", "text": "event_type", "int": "user_id"},
}

# Given table behind the source that a key stem points at, and versions per key there.
REFERRED = {
    "agence": ("supplier", 4),
    "conseiller": ("supplier", 2),
    "partenaire": ("customer", 5),
    "investisseur": ("customer", 2),
    "produit": ("part", 10),
    "programme": ("part", 4),
    "lot": ("orders", 3),
}
FOREIGN = {
    ("orders", "customer"): "o_custkey",
    ("lineitem", "part"): "l_partkey",
    ("lineitem", "supplier"): "l_suppkey",
    ("lineitem", "orders"): "l_orderkey",
    ("events", "customer"): "user_id",
}
# Relative numbers of rows; a key without a column of its own is the row number brought to the other table's size.
SIZES = {"supplier": 1, "customer": 15, "part": 20, "orders": 150, "lineitem": 1200, "events": 100}
HOT = ("investisseur", "agence")


def _pick(values: list[str | None], shift: int) -> str:
    arms = " ".join(f"when {n} then '{v}'" for n, v in enumerate(values) if v is not None)
    return f"case (k + {shift}) % {len(values)} {arms} end"


def _day(table: str, shift: int) -> str:
    """A day some weeks after the row's own date."""
    own = VALUES[table].get("date")
    if own:
        return f"cast(cast({own} as date) + cast({shift * 11 % 90} as int) as string)"
    return f"cast(date '2024-01-01' + cast((k * 3 + {shift * 11}) % 700 as int) as string)"


def _reference(table: str, stem: str, shift: int) -> str:
    target, versions = REFERRED.get(stem, (table, 1))
    number = FOREIGN.get((table, target), "k" if target == table else f"floor(k * {SIZES[target]} / {SIZES[table]})")
    known = f"concat('{stem.upper()}-', cast(cast(floor({number} / {versions}) as bigint) as string))"
    hot = f"when k % 3 = 0 then '{stem.upper()}-1' " if stem in HOT else ""
    return f"case when (k + {shift}) % 11 = 0 then null when (k + {shift}) % 17 = 0 then 'X' {hot}else {known} end"


def source_columns(name: str) -> dict[str, str]:
    """Column to expression over a given table's columns and its row number `k`, for one source table."""
    spec = catalogue.SILVER[name]
    table, versions = ORIGINS[name]
    own = VALUES[table]
    columns: dict[str, str] = {}
    for shift, (column, kind) in enumerate(spec.columns.items()):
        stem = column.removesuffix("_id")
        if column == spec.key:
            text = f"concat('{stem.upper()}-', cast(cast(floor(k / {versions}) as bigint) as string))"
        elif kind == "id":
            text = _reference(table, stem, shift)
        elif column == spec.version_order[0]:
            text = f"case when k % 23 = 0 then 'n/a' else concat({_day(table, shift)}, ' 08:', cast(10 + k % 50 as string), ':00') end"
        elif kind == "timestamp":
            text = f"concat({_day(table, shift)}, ' 10:00:00')"
        elif column == "is_deleted":
            text = "case when k % 7 = 0 then ' OUI' when k % 7 = 1 then null else '0' end"
        elif column == "is_active":
            text = "case when k % 7 = 0 then 'non' else 'Yes ' end"
        elif kind == "flag":
            text = _pick(["1", "0", "oui", "non", None, "a, b"], shift)
        elif column == "annee":
            text = f"case when k % 9 = 0 then 'x' else cast(year({own['date']}) as string) end"
        elif column == "mois":
            text = f"case when k % 13 = 0 then '13' else cast(month({own['date']}) as string) end"
        elif column == "access_level":
            text = _pick(["scope", " Scope ", "agence", "region", "scope", "scope", "all", "scope", "scope", "adv ", "scope"], shift)
        elif column == "user_email":
            text = "case when k % 19 = 0 then ' ' else concat('User', cast(k % 211 as string), '@Example.com ') end"
        elif kind == "date":
            text = f"case (k + {shift}) % 6 when 0 then '' when 1 then 'n/a' else {_day(table, shift)} end"
        elif kind == "int":
            text = f"case (k + {shift}) % 8 when 0 then 'x' when 1 then '7.0' else cast(cast({own['int']} as bigint) + {shift} as string) end"
        elif kind == "code":
            text = f"case (k + {shift}) % 5 when 0 then 'disponible' when 1 then ' Refuse ' when 2 then null else concat(' ', {own['code']}) end"
        elif kind == "lower":
            text = f"concat(' Mail', {own['text']}, cast(k as string), '@Example.COM ')"
        elif kind == "text":
            text = f"case (k + {shift}) % 5 when 0 then null when 1 then '' else concat(' {column} ', {own['text']}, ' ') end"
        elif kind == "18,2":
            text = f"case (k + {shift}) % 9 when 0 then '' when 1 then '-12.5' when 2 then '1e3' else cast(cast({own['money']} as decimal(18,2)) as string) end"
        else:
            number = f"cast(cast({own['rate']} as decimal(9,4)) as string)" if "rate" in own else f"concat('0.0', cast(10 + (k * 7 + {shift}) % 90 as string), '5')"
            text = f"case (k + {shift}) % 9 when 0 then 'n/a' else {number} end"
        columns[column] = text
    return columns


class PropertyModel:
    """The layers over one set of given tables; nothing runs until a result is asked for."""

    def __init__(self, t: Tables) -> None:
        self.t = t

    def bronze(self, name: str, ranked: bool = False, narrow: bool = False) -> DataFrame:
        """`ranked` if the versions of a key are compared next, `narrow` if few of the columns are read then."""
        table, versions = ORIGINS[name]
        keys = [F.floor(F.expr(ROWS[table]) / versions)] if ranked else []
        rows = dealt(getattr(self.t, table), keys, None if narrow else TASK_ROWS).withColumn("k", F.expr(ROWS[table]).cast("long"))
        return rows.select(*[F.expr(text).alias(column) for column, text in source_columns(name).items()])

    def silver(self, name: str) -> DataFrame:
        return silver_table(self.bronze(name, ranked=True), catalogue.SILVER[name])

    def versions(self, name: str) -> DataFrame:
        """All typed versions; a reader of few columns scans few columns and shuffles nothing."""
        return silver_table(self.bronze(name), catalogue.SILVER[name], dedup=False)

    def silver_of(self, reads: dict[str, set[str]]) -> dict[str, DataFrame]:
        """Stored silver tables that hold the columns named for each and its version time."""

        def one(item: tuple[str, set[str]]) -> DataFrame:
            name, columns = item
            spec = catalogue.SILVER[name]
            return silver_columns(self.bronze(name, ranked=True, narrow=True), spec, columns | {spec.version_order[0]}, lambda df: materialise(df, name))

        with ThreadPoolExecutor(max_workers=8) as pool:
            return dict(zip(reads, pool.map(one, reads.items()), strict=True))

    def dimensions(self, *names: str, reads: dict[str, set[str]] | None = None) -> dict[str, DataFrame]:
        """The dimensions and their parents, stored in dependency order, independent ones together.

        With `reads` (columns by dimension) they hold their keys and what is read.
        """
        specs = catalogue.DIMENSIONS
        wanted: set[str] = set()
        pending = [n for n in names if n in specs]
        while pending:
            name = pending.pop()
            if name not in wanted:
                wanted.add(name)
                pending += [p.dimension for p in specs[name].parents]
        silver = None if reads is None else self.silver_of({specs[n].source: read_by_dimension(specs[n]) | reads.get(n, set()) for n in wanted})
        built: dict[str, DataFrame] = {}
        while wanted - set(built):
            ready = [n for n in specs if n in wanted - set(built) and all(p.dimension in built for p in specs[n].parents)]
            rows = {n: self.silver(specs[n].source) if silver is None else silver[specs[n].source] for n in ready}
            built |= materialise_all({n: dimension(rows[n], specs[n], built, latest=False) for n in ready})
        return built

    def statuses(self, *domains: str) -> DataFrame:
        sources = catalogue.STATUS_DOMAINS
        return domain_values({d: (self.versions(sources[d][0]), sources[d][1]) for d in domains or sources})

    def dates(self, *facts: str) -> DataFrame:
        """Dates of the facts' sources, seen in any version."""
        sources = catalogue.date_sources({catalogue.FACTS[f].source: self.versions(catalogue.FACTS[f].source) for f in facts or catalogue.FACTS})
        return observed_dates(sources)

    def fact(self, name: str, dimensions: dict[str, DataFrame] | None = None, only: set[str] | None = None) -> DataFrame:
        spec = catalogue.FACTS[name]
        dims = dict(dimensions) if dimensions else self.looked_up(spec)
        if spec.status and "dim_statut" not in dims and (only is None or "statut_key" in only):
            dims["dim_statut"] = materialise(self.statuses(spec.status[0]), "dim_statut")
        return fact(self.silver(spec.source), spec, dims, only, unique=True)

    def looked_up(self, spec) -> dict[str, DataFrame]:
        """The dimensions of a fact with what its lookups and their own parents read."""
        return self.dimensions(*[target.dimension for target in spec.lookups], reads={})

    def facts(self, *names: str, reads: dict[str, set[str]] | None = None) -> dict[str, DataFrame]:
        """The facts and what they look up; with `reads` (columns by table) only the lookups and columns that are read."""
        specs = [catalogue.FACTS[n] for n in names]
        keys = {spec.name: None if reads is None else reads.get(spec.name, set()) for spec in specs}
        read = lambda spec, key: keys[spec.name] is None or key in keys[spec.name]
        dims = self.dimensions(*[target.dimension for spec in specs for target in spec.lookups if read(spec, target.key)], reads=reads)
        domains = [spec.status[0] for spec in specs if spec.status and read(spec, "statut_key")]
        if domains:
            dims["dim_statut"] = materialise(self.statuses(*domains), "dim_statut")
        if reads is None:
            return {**dims, **{spec.name: self.fact(spec.name, dims) for spec in specs}}
        silver = self.silver_of({spec.source: read_by_fact(spec, keys[spec.name]) | _behind(spec, keys[spec.name]) for spec in specs})
        return {**dims, **{spec.name: fact(silver[spec.source], spec, dims, keys[spec.name]) for spec in specs}}


def _behind(spec, columns: set[str]) -> set[str]:
    """Source columns that the columns of a gold table come from; all of them if it has derived ones."""
    source = catalogue.SILVER[spec.source].columns
    return set(source) if getattr(spec, "extra", None) else {c for c in source if c in columns or f"{c}_key" in columns}


# The same layers in SQL.

_CASTS = {
    "id": "{c}",
    "text": "trim({c})",
    "code": "upper(trim({c}))",
    "lower": "lower(trim({c}))",
    "date": "TRY_CAST({c} AS DATE)",
    "timestamp": "TRY_CAST({c} AS TIMESTAMP)",
    "int": "CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST({c} AS INTEGER) END",
    "flag": "coalesce(lower(trim({c})) IN ('1', 'true', 'oui', 'yes'), false)",
}
UNKNOWN_SQL = "sha256('__UNKNOWN__')"


def silver_sql(name: str, dedup: bool = True) -> str:
    spec = catalogue.SILVER[name]
    table, _ = ORIGINS[name]
    raw = ", ".join(f"{text} AS {column}" for column, text in source_columns(name).items())
    typed = ", ".join(f"{_CASTS.get(k, 'TRY_CAST({c} AS DECIMAL(' + k + '))').format(c=c)} AS {c}" for c, k in spec.columns.items())
    rows = f"SELECT {typed} FROM (SELECT {raw} FROM (SELECT *, CAST({ROWS[table]} AS BIGINT) AS k FROM {table}))"
    if not dedup:
        return rows
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {spec.key} "
        f"ORDER BY {_newest_sql(name)}) AS rn FROM ({rows})) WHERE rn = 1"
    )


def _newest_sql(name: str) -> str:
    """Newest first; equal times by all other columns, as rows of a given table may repeat."""
    spec = catalogue.SILVER[name]
    first, second = spec.version_order
    others = [c for c in spec.columns if c not in (first, second, spec.key)]
    return f"{first} DESC NULLS LAST, {second} DESC NULLS LAST, {', '.join(f'{c} ASC NULLS LAST' for c in others)}"


def _found(stem: str, source: str, row: str) -> str:
    """Key of the member that `row` refers to: its hash if the member exists, else the unknown key."""
    alive = " AND NOT is_deleted" if catalogue.SILVER[source].deleted else ""
    members = f"SELECT {stem}_id FROM s_{source} WHERE {stem}_id IS NOT NULL{alive}"
    return f"CASE WHEN {row}.{stem}_id IN ({members}) THEN sha256({row}.{stem}_id) ELSE {UNKNOWN_SQL} END"


def _with(*sources: str, dedup: bool = True) -> str:
    return "WITH " + ", ".join(f"s_{name} AS ({silver_sql(name, dedup)})" for name in dict.fromkeys(sources))


def _sources(name: str) -> list[str]:
    """Silver tables behind a gold table."""
    spec = catalogue.DIMENSIONS.get(name) or catalogue.FACTS[name]
    targets = spec.parents if name in catalogue.DIMENSIONS else spec.lookups
    return [spec.source, *[catalogue.DIMENSIONS[target.dimension].source for target in targets]]


def dimension_rows_sql(name: str) -> str:
    spec = catalogue.DIMENSIONS[name]
    columns = [f"sha256(f.{spec.natural_key}) AS {spec.key}", "f.*"]
    unknown = {spec.key: UNKNOWN_SQL, spec.natural_key: "'__UNKNOWN__'"}
    for parent in spec.parents:
        stem = parent.natural_key.removesuffix("_id")
        columns.append(f"{_found(stem, catalogue.DIMENSIONS[parent.dimension].source, 'f')} AS {parent.key}")
        unknown |= {parent.key: UNKNOWN_SQL, parent.foreign_key: "'__UNKNOWN__'"}
    if spec.full_name:
        new, first, last = spec.full_name
        columns.append(f"coalesce(f.{first}, '') || ' ' || coalesce(f.{last}, '') AS {new}")
    unknown |= {c: f"'{v}'" if isinstance(v, str) else str(v).lower() for c, v in spec.unknown.items()}
    alive = " AND NOT f.is_deleted" if spec.deleted else ""
    known = f"SELECT {', '.join(columns)} FROM s_{spec.source} f WHERE f.{spec.natural_key} IS NOT NULL{alive}"
    member = "SELECT " + ", ".join(f"{value} AS {column}" for column, value in unknown.items())
    return f"{known} UNION ALL BY NAME {member}"


def fact_rows_sql(name: str) -> str:
    spec = catalogue.FACTS[name]
    columns = [f"sha256(f.{spec.natural_key}) AS {spec.key}"]
    for column, kind in catalogue.SILVER[spec.source].columns.items():
        if kind == "date":
            columns.append(f"CAST(strftime(f.{column}, '%Y%m%d') AS INTEGER) AS {column}_key")
        elif column != "is_deleted" and column not in spec.drop:
            columns.append(f"f.{column}")
    for target in spec.lookups:
        stem = target.natural_key.removesuffix("_id")
        columns.append(f"{_found(stem, catalogue.DIMENSIONS[target.dimension].source, 'f')} AS {target.key}")
    if spec.status:
        domain, status = spec.status
        columns.append(f"sha256('{domain}-' || coalesce(upper(trim(f.{status})), '__UNKNOWN__')) AS statut_key")
    if name == "fact_objectif_commercial":
        null = NULL_TOKEN
        columns.append("CASE WHEN f.mois BETWEEN 1 AND 12 THEN CAST(f.annee * 10000 + f.mois * 100 + 1 AS INTEGER) END AS date_objectif_key")
        columns.append(f"sha256(coalesce(f.famille_produit, '{null}') || '-' || coalesce(f.type_produit, '{null}')) AS produit_objectif_key")
    alive = "NOT f.is_deleted" if catalogue.SILVER[spec.source].deleted else "f.is_active"
    return f"SELECT {', '.join(columns)} FROM s_{spec.source} f WHERE {alive}"


for _name in catalogue.SILVER:

    @query(f"silver_{_name}", silver_sql(_name))
    def _(t: Tables, name=_name):
        return PropertyModel(t).silver(name)


@query("silver_all_versions", silver_sql("ventes_immobilieres", dedup=False))
def _(t: Tables):
    return silver_table(PropertyModel(t).bronze("ventes_immobilieres"), catalogue.SILVER["ventes_immobilieres"], dedup=False)


for _name in catalogue.DIMENSIONS:

    @query(_name, f"{_with(*_sources(_name))} {dimension_rows_sql(_name)}")
    def _(t: Tables, name=_name):
        return PropertyModel(t).dimensions(name)[name]


for _name in catalogue.FACTS:

    @query(_name, f"{_with(*_sources(_name))} {fact_rows_sql(_name)}")
    def _(t: Tables, name=_name):
        return PropertyModel(t).fact(name)


# The variants without deduplication in silver: dimensions rank all live versions, facts hold every version.

_CLIENT_PARENTS = ("dim_agence_region", "dim_partenaire", "dim_conseiller")
_LIVE_CLIENTS = (
    "s_crm_investisseurs AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY investisseur_id "
    f"ORDER BY {_newest_sql('crm_investisseurs')}) AS rn "
    f"FROM ({silver_sql('crm_investisseurs', dedup=False)}) WHERE NOT is_deleted) WHERE rn = 1)"
)


@query(
    "dim_investisseur_from_versions",
    f"{_with(*[catalogue.DIMENSIONS[n].source for n in _CLIENT_PARENTS])}, {_LIVE_CLIENTS} {dimension_rows_sql('dim_investisseur')}",
)
def _(t: Tables):
    model = PropertyModel(t)
    names = {*_CLIENT_PARENTS, "dim_investisseur"}
    versions = {catalogue.DIMENSIONS[n].source: model.versions(catalogue.DIMENSIONS[n].source) for n in names}
    built = pipeline.build_dimensions(
        versions, latest=True, deleted_policy="before", only=names, save=lambda _, name, df: materialise(df, name)
    )
    return built["dim_investisseur"]


@query(
    "fact_vente_from_versions",
    f"{_with(*_sources('fact_vente')[1:])}, s_ventes_immobilieres AS ({silver_sql('ventes_immobilieres', dedup=False)}) {fact_rows_sql('fact_vente')}",
)
def _(t: Tables):
    model = PropertyModel(t)
    spec = catalogue.FACTS["fact_vente"]
    dims = model.looked_up(spec)
    dims["dim_statut"] = materialise(model.statuses("VENTE"), "dim_statut")
    return fact(model.versions(spec.source), spec, dims)


def _days_sql() -> str:
    parts = []
    for spec in catalogue.FACTS.values():
        days = [c for c, k in catalogue.SILVER[spec.source].columns.items() if k == "date"]
        parts += [f"SELECT {d} AS d FROM s_{spec.source}" for d in days]
    parts.append("SELECT CASE WHEN mois BETWEEN 1 AND 12 THEN CAST(make_date(CAST(annee AS BIGINT), CAST(mois AS BIGINT), 1) AS DATE) END FROM s_objectifs_commerciaux")
    return " UNION ".join(parts)


_ALL_FACT_SOURCES = [spec.source for spec in catalogue.FACTS.values()]


@query("dim_date", f"{_with(*_ALL_FACT_SOURCES, dedup=False)} SELECT {CALENDAR_SQL} FROM ({_days_sql()}) WHERE d IS NOT NULL")
def _(t: Tables):
    return PropertyModel(t).dates()


@query(
    "dim_statut",
    _with(*[source for source, _ in catalogue.STATUS_DOMAINS.values()], dedup=False)
    + " SELECT sha256(domaine_statut || '-' || statut_value) AS statut_key, * FROM ("
    + " UNION ".join(
        f"SELECT '{d}' AS domaine_statut, upper(trim({c})) AS statut_value FROM s_{s} WHERE {c} IS NOT NULL UNION SELECT '{d}', '__UNKNOWN__'"
        for d, (s, c) in catalogue.STATUS_DOMAINS.items()
    )
    + ")",
)
def _(t: Tables):
    return PropertyModel(t).statuses()


_GRANT = ("user_email", "role_metier", "access_level", "region_id", "agence_id", "conseiller_id", "partenaire_id")


def _access_sql() -> str:
    null = NULL_TOKEN
    key = " || '-' || ".join(f"coalesce({c}, '{null}')" for c in _GRANT)
    groups = ", ".join(f"coalesce({c}, 'none')" for c in _GRANT)
    return (
        f"SELECT sha256({key}) AS security_access_key, * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {groups} "
        "ORDER BY updated_at DESC NULLS LAST, created_at DESC NULLS LAST, user_access_id) AS rn FROM s_security_user_access "
        "WHERE user_email <> '') WHERE rn = 1"
    )


@query("security_user_access", f"{_with('security_user_access')} {_access_sql()}")
def _(t: Tables):
    return access_table(PropertyModel(t).silver("security_user_access"))


_QUALITY_TABLES = tuple(dict.fromkeys(check.table for check in catalogue.QUALITY_CHECKS))


def _gold_sql(*names: str) -> str:
    sources = [s for n in names for s in _sources(n)]
    rows = {n: dimension_rows_sql(n) if n in catalogue.DIMENSIONS else fact_rows_sql(n) for n in names}
    return _with(*sources) + ", " + ", ".join(f"{n} AS ({sql})" for n, sql in rows.items())


def _quality_rows_sql() -> str:
    failed = {
        "null_check": "CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)",
        "range_check": "CAST(sum(CASE WHEN {c} < 0 THEN 1 ELSE 0 END) AS BIGINT)",
        "duplicate_check": "count(*) - count(DISTINCT {c})",
    }
    checks = " UNION ALL ".join(
        f"SELECT '{c.table}' AS table_name, '{c.column}' AS column_name, '{c.kind}' AS check_type, count(*) AS n, "
        f"{failed[c.kind].format(c=c.column)} AS failed FROM {c.table}"
        for c in catalogue.QUALITY_CHECKS
    )
    return (
        f"SELECT TIMESTAMP '{LOAD_TIME}' AS checked_at, 'gold' AS table_schema, table_name, column_name, "
        f"check_type, n AS records_checked, failed AS records_failed, {RATE_SQL} FROM ({checks})"
    )


def _quality_sql() -> str:
    return f"{_gold_sql(*_QUALITY_TABLES)} {_quality_rows_sql()}"


def _gold(t: Tables, *names: str, reads: dict[str, set[str]] | None = None) -> dict[str, DataFrame]:
    model = PropertyModel(t)
    facts = [n for n in names if n in catalogue.FACTS]
    tables = model.facts(*facts, reads=reads) if facts else {}
    missing = [n for n in names if n in catalogue.DIMENSIONS and n not in tables]
    return {**tables, **model.dimensions(*missing, reads=reads)}


def _checked_columns() -> dict[str, set[str]]:
    return {check.table: {c.column for c in catalogue.QUALITY_CHECKS if c.table == check.table} for check in catalogue.QUALITY_CHECKS}


@query("tech_data_quality_log", _quality_sql())
def _(t: Tables):
    return quality_log(_gold(t, *_QUALITY_TABLES, reads=_checked_columns()), catalogue.QUALITY_CHECKS, F.lit(LOAD_TIME).cast("timestamp_ntz"))


def _freshness_rows_sql() -> str:
    gold = [*catalogue.FACTS, *catalogue.DIMENSIONS]
    probes = [("silver", n, f"s_{n}", s.version_order[0]) for n, s in catalogue.SILVER.items() if n != "security_user_access"]
    for name in gold:
        spec = catalogue.DIMENSIONS.get(name) or catalogue.FACTS[name]
        probes.append(("gold", name, name, catalogue.SILVER[spec.source].version_order[0]))
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS table_schema, '{name}' AS table_name, max({column}) AS last_load_time, count(*) AS row_count, "
        f"TIMESTAMP '{LOAD_TIME}' AS checked_at FROM {table}"
        for layer, name, table, column in probes
    )


def _freshness_sql() -> str:
    gold = [*catalogue.FACTS, *catalogue.DIMENSIONS]
    silver = _with(*[n for n in catalogue.SILVER if n != "security_user_access"])
    built = ", ".join(
        f"{n} AS ({dimension_rows_sql(n) if n in catalogue.DIMENSIONS else fact_rows_sql(n)})" for n in gold
    )
    return f"{silver}, {built} {_freshness_rows_sql()}"


def _stored_columns(name: str, reads: dict[str, set[str]]) -> set[str]:
    """Columns of a silver table that the gold tables are built from, and those behind what is read of them."""
    spec = catalogue.SILVER[name]
    dims = [s for s in catalogue.DIMENSIONS.values() if s.source == name]
    facts = [s for s in catalogue.FACTS.values() if s.source == name]
    columns = {spec.key, *reads.get(name, ())}
    columns |= set().union(*[read_by_dimension(s) for s in dims], *[read_by_fact(s) for s in facts])
    columns |= set().union(*[_behind(s, reads.get(s.name, set())) for s in (*dims, *facts)])
    columns |= {column for source, column in catalogue.STATUS_DOMAINS.values() if source == name}
    if facts:
        columns |= {c for c, kind in spec.columns.items() if kind == "date"}
    return set(spec.columns) if name == "security_user_access" else columns


def _probed_columns(name: str) -> set[str]:
    """Columns of a silver table that its row count and newest time, and those of the gold tables built from it, come from."""
    spec = catalogue.SILVER[name]
    facts = [s for s in catalogue.FACTS.values() if s.source == name]
    columns = {spec.key, spec.version_order[0]}.union(*[read_by_fact(s, ()) | _behind(s, set()) for s in facts])
    return columns.union(*[read_by_dimension(s) for s in catalogue.DIMENSIONS.values() if s.source == name])


def probed_layers(t: Tables) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The silver tables, dimensions and facts that freshness probes, with nothing but what it reads.

    As for measures, a fact has no lookup of a key that nobody reads (a lookup never changes its rows), and
    dates, statuses and grants are not probed.
    """
    model = PropertyModel(t)
    silver = model.silver_of({name: _probed_columns(name) for name in catalogue.SILVER if name != "security_user_access"})
    gold = _stored_dimensions(silver)
    return silver, {**gold, **pipeline.build_facts(silver, gold, only={})}


def _stored_dimensions(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    base = catalogue.DIMENSIONS
    gold: dict[str, DataFrame] = {}
    while set(base) - set(gold):
        ready = [n for n in base if n not in gold and all(p.dimension in gold for p in base[n].parents)]
        gold |= materialise_all({n: dimension(silver[base[n].source], base[n], gold, latest=False) for n in ready})
    return gold


def stored_layers(t: Tables, reads: dict[str, set[str]]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All silver and gold tables with the columns that keys, dates and statuses come from and those in
    `reads` (columns by silver or gold table).

    Each silver table, dimension, date and status is stored once. Facts are plans over stored tables: their hash
    keys, 64 characters each, would be most of the disk.
    """
    model = PropertyModel(t)
    silver = model.silver_of({name: _stored_columns(name, reads) for name in catalogue.SILVER})
    gold = _stored_dimensions(silver)
    rest = pipeline.build_dimensions(silver, only={"dim_date", "dim_statut"})
    gold |= materialise_all({n: rest[n] for n in ("dim_date", "dim_statut")})
    gold |= materialise_all({"security_user_access": access_table(silver["security_user_access"])})
    return silver, {**gold, **pipeline.build_facts(silver, gold)}


@query("tech_data_freshness", _freshness_sql())
def _(t: Tables):
    silver, gold = probed_layers(t)
    return freshness(pipeline.freshness_tables(silver, gold), F.lit(LOAD_TIME).cast("timestamp_ntz"))


RUN_LOG_SQL = f"""SELECT CAST(event_id AS VARCHAR) AS run_id, 'user-' || user_id AS pipeline_name, 'DEV' AS environment, event_type AS status,
           ts AS start_time, ts + INTERVAL 1 MINUTE AS end_time, CAST(floor(CAST(round(value * 100) AS BIGINT) / 1000) AS BIGINT) AS duration_seconds,
           event_id AS rows_processed, CASE WHEN event_type = 'error' THEN '404' END AS error_message, TIMESTAMP '{LOAD_TIME}' AS inserted_at
    FROM events WHERE ts + INTERVAL 720 DAY >= TIMESTAMP '{LOAD_TIME}' - INTERVAL 7 DAY AND event_type <> 'signup'"""


def _tests_sql() -> str:
    """Never-null and unique tests as separate counts over every built table."""
    tests: list[tuple[str, str, list[str], list[str]]] = []
    more = {"commissions": ["type_operation"], "objectifs_commerciaux": ["annee", "mois"], "security_user_access": ["user_email", "role_metier"]}
    for name, spec in catalogue.SILVER.items():
        state = next(c for c in spec.columns if c in ("is_deleted", "is_active"))
        tests.append((name, f"s_{name}", [spec.key, state, *more.get(name, [])], [] if name == "security_user_access" else [spec.key]))
    for name, spec in {**catalogue.DIMENSIONS, **catalogue.FACTS}.items():
        targets = spec.parents if name in catalogue.DIMENSIONS else spec.lookups
        filled = [spec.key, spec.natural_key, *[target.key for target in targets]]
        if name in catalogue.FACTS and name != "fact_objectif_commercial":
            filled.append("statut_key")
        filled += {"fact_vente": ["prix_vente_ttc"], "fact_souscription_pierre_papier": ["montant_souscrit"]}.get(name, [])
        tests.append((name, name, filled, [spec.key, spec.natural_key]))
    tests.append(("dim_date", "dim_date", ["date_key", "full_date"], ["date_key"]))
    tests.append(("dim_statut", "dim_statut", ["statut_key", "domaine_statut", "statut_value"], ["statut_key"]))
    tests.append(("gold_security_user_access", "access", ["security_access_key", "user_email", "role_metier"], ["security_access_key"]))
    rows = []
    for label, table, filled, unique in tests:
        rows += [f"SELECT '{label}' AS table_name, '{c}' AS column_name, 'not_null' AS test, count(*) - count({c}) AS n_failures FROM {table}" for c in filled]
        rows += [f"SELECT '{label}', '{c}', 'unique', count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)" for c in unique]
    for name, (filled, unique, _) in catalogue.TECH_TESTS.items():
        rows += [f"SELECT '{name}', '{c}', 'not_null', count(*) - count({c}) FROM {name}" for c in filled]
        rows += [f"SELECT '{name}', '{c}', 'unique', count(*) FROM (SELECT {c} FROM {name} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)" for c in unique]
    accepted = [("dim_statut", "domaine_statut", list(catalogue.STATUS_DOMAINS))]
    accepted += [(name, c, values) for name, (_, _, by_column) in catalogue.TECH_TESTS.items() for c, values in by_column.items()]
    for name, column, values in accepted:
        listed = ", ".join(f"'{v}'" for v in values)
        rows.append(f"SELECT '{name}', '{column}', 'accepted_values', count(DISTINCT {column}) FROM {name} WHERE {column} NOT IN ({listed})")
    gold = {**catalogue.DIMENSIONS, **catalogue.FACTS}
    built = ", ".join(f"{n} AS ({dimension_rows_sql(n) if n in catalogue.DIMENSIONS else fact_rows_sql(n)})" for n in gold)
    statuses = " UNION ".join(
        f"SELECT '{d}' AS domaine_statut, {c} AS statut_value FROM s_{s} WHERE {c} IS NOT NULL UNION SELECT '{d}', '__UNKNOWN__'"
        for d, (s, c) in catalogue.STATUS_DOMAINS.items()
    )
    return (
        f"{_with(*catalogue.SILVER)}, {built}, dim_date AS (SELECT {CALENDAR_SQL} FROM ({_days_sql()}) WHERE d IS NOT NULL), "
        f"dim_statut AS (SELECT sha256(domaine_statut || '-' || statut_value) AS statut_key, * FROM ({statuses})), "
        f"access AS ({_access_sql()}), data_freshness AS ({_freshness_rows_sql()}), data_quality_log AS ({_quality_rows_sql()}), "
        f"pipeline_run_log AS ({RUN_LOG_SQL}) {' UNION ALL '.join(rows)}"
    )


def _tested_columns() -> dict[str, set[str]]:
    """Columns by table that the data tests and the quality log read."""
    reads: dict[str, set[str]] = {}
    for name, spec in catalogue.SILVER.items():
        reads[name] = {c for c in ("is_deleted", "is_active") if c in spec.columns} | set(pipeline.NEVER_NULL.get(name, ()))
    for name, spec in {**catalogue.DIMENSIONS, **catalogue.FACTS}.items():
        reads[name] = set().union(*catalogue.required_columns(spec))
    for name, columns in _checked_columns().items():
        reads[name] = reads.get(name, set()) | columns
    return reads


def statements(t: Tables) -> DataFrame:
    """The events as statements of a warehouse, moved by whole days so that the last week is in reach."""
    return t.events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("pipeline_name"),
        F.when(F.col("event_type") == "signup", "USE").otherwise("SELECT").alias("statement_type"),
        F.col("event_type").alias("status"),
        (F.col("ts") + F.expr("INTERVAL 720 DAYS")).alias("start_time"),
        (F.col("ts") + F.expr("INTERVAL 720 DAYS") + F.expr("INTERVAL 1 MINUTE")).alias("end_time"),
        F.round(F.col("value") * 100).cast("long").alias("elapsed_ms"),
        F.col("event_id").alias("row_count"),
        F.when(F.col("event_type") == "error", 404).otherwise(0).alias("error_code"),
    )


@query(
    "tech_pipeline_run_log",
    RUN_LOG_SQL.replace("ts AS start_time, ts + INTERVAL 1 MINUTE", "ts + INTERVAL 720 DAY AS start_time, ts + INTERVAL 720 DAY + INTERVAL 1 MINUTE"),
)
def _(t: Tables):
    built = pipeline.build_tech({}, _gold(t, *_QUALITY_TABLES, reads=_checked_columns()), F.lit(LOAD_TIME).cast("timestamp_ntz"), statements(t))
    return built["pipeline_run_log"]


@query("tech_data_tests", _tests_sql())
def _(t: Tables):
    silver, gold = stored_layers(t, _tested_columns())
    probed = {**gold, **pipeline.build_facts(silver, gold, only=_checked_columns())}
    tech = materialise_all(pipeline.build_tech(silver, probed, F.lit(LOAD_TIME).cast("timestamp_ntz"), statements(t)))
    return pipeline.data_tests(silver, gold, tech)


@query("fact_vente_keys_only", f"{_with(*_sources('fact_vente'))} {fact_rows_sql('fact_vente')}")
def _(t: Tables):
    """The widest fact, seven lookups, with no dimension joined on its own."""
    model, spec = PropertyModel(t), catalogue.FACTS["fact_vente"]
    dims = model.looked_up(spec)
    dims["dim_statut"] = materialise(model.statuses(spec.status[0]), "dim_statut")
    return fact(model.silver(spec.source), spec, dims, direct_up_to=-1, unique=True)


# Measures

_CONDITIONS = {
    "Nb Dossiers Pièces Manquantes": ("pieces_manquantes",) * 2,
    "Nb Dossiers Bloqués": ("blocage_adv",) * 2,
    "Ventes Sans Date Acte": ("date_signature_acte_key IS NULL",) * 2,
    "Ventes Sans Investisseur": ("investisseur_key IS NULL", f"investisseur_key = {UNKNOWN_SQL}"),
    "Réservations Sans Lot": ("lot_key IS NULL", f"lot_key = {UNKNOWN_SQL}"),
    "Commissions Bloquées": ("motif_blocage IS NOT NULL",) * 2,
    "Dossiers ADV Bloqués": ("blocage_adv",) * 2,
    "Dossiers Pièces Manquantes": ("pieces_manquantes",) * 2,
    "Financements Refusés": ("statut_financement = 'Refusé'", "statut_financement = 'REFUSE'"),
    "Lots Vendus Encore Disponibles": (
        "statut_lot = 'Disponible' AND date_vente IS NOT NULL",
        "statut_lot = 'DISPONIBLE' AND date_vente IS NOT NULL",
    ),
}


def _measure_sql(name: str, normalised: bool) -> str:
    m = catalogue.measures()[name]
    if name in _CONDITIONS:
        where = _CONDITIONS[name][normalised]
        counted = f"count(DISTINCT {m.column})" if m.kind == "distinct" else "count(*)"
        return f"nullif({counted} FILTER ({where}), 0)"
    return {
        "sum": f"CAST(sum({m.column}) AS BIGINT)" if m.column == "nombre_lots_disponibles" else f"sum({m.column})",
        "avg": f"CAST(sum({m.column}) AS DOUBLE) / nullif(count({m.column}), 0)",
        "count": "count(*)",
        "distinct": f"nullif(count(DISTINCT {m.column}) + max(CASE WHEN {m.column} IS NULL THEN 1 ELSE 0 END), 0)",
    }[m.kind]


def measures_of(*tables: str) -> list[str]:
    return [m.name for m in catalogue.measures().values() if m.table in tables]


def _group_sql(table: str, dim: str, column: str, names: list[str], normalised: bool) -> str:
    """Measures of one table by a column of a related dimension, or of its own."""
    values = ", ".join(f'{_measure_sql(n, normalised)} AS "{n}"' for n in names)
    if table == dim:
        return f"SELECT {column}, {values} FROM {table} GROUP BY ALL"
    if dim == "dim_date":
        key = catalogue.FACTS[table].date_role
        return f"SELECT {key} // 10000 AS {column}, {values} FROM {table} GROUP BY ALL"
    key = catalogue.DIMENSIONS[dim].key
    return f"SELECT {column}, {values} FROM {table} JOIN (SELECT {key}, {column} FROM {dim}) USING ({key}) GROUP BY ALL"


def _measures_query(name: str, dim: str, column: str, tables: tuple[str, ...], normalised: bool = False, ratios: tuple[str, ...] = ()) -> None:
    per_table = {table: measures_of(table) for table in tables}
    names = [n for group in per_table.values() for n in group]
    gold = [*tables] + ([dim] if dim != "dim_date" and dim not in tables else [])
    parts = ", ".join(f"m_{table} AS ({_group_sql(table, dim, column, own, normalised)})" for table, own in per_table.items())
    stacked = " UNION ALL BY NAME ".join(f"SELECT * FROM m_{table}" for table in tables)
    lined_up = ", ".join(f'max("{n}") AS "{n}"' for n in names)
    joins = f"(SELECT {column}, {lined_up} FROM ({stacked}) GROUP BY {column})"
    definitions = catalogue.measures()
    quoted = [f'"{n}"' for n in names]
    for ratio in ratios:
        m = definitions[ratio]
        quoted.append(f'CAST("{m.numerator}" AS DOUBLE) / nullif(CAST("{m.denominator}" AS DOUBLE), 0) AS "{ratio}"')
    sql = f"{_gold_sql(*gold)}, {parts} SELECT {column}, {', '.join(quoted)} FROM {joins}"

    @query(name, sql)
    def _(t: Tables):
        model = PropertyModel(t)
        reads = needed(catalogue.relationships(), catalogue.measures(normalised), [*names, *ratios], [dim])
        reads.setdefault(dim, set()).add(column)
        built = _gold(t, *gold, reads=reads)
        if dim == "dim_date":
            built["dim_date"] = model.dates(*tables)
        return measure_query(catalogue.model(built, normalised), [*names, *ratios], [(dim, column)])


_measures_query(
    "measures_by_year",
    "dim_date",
    "annee",
    ("fact_vente", "fact_reservation", "fact_objectif_commercial"),
    ratios=("Taux Réservation Vente", "Taux Atteinte Objectif CA", "CA Moyen Vente"),
)
_measures_query("measures_by_client_city", "dim_investisseur", "ville", ("fact_vente", "fact_financement", "fact_gestion_locative", "dim_investisseur"))
_measures_query("measures_by_adviser_status", "dim_conseiller", "statut_collaborateur", ("fact_commission", "fact_dossier_adv"))
_measures_query("measures_by_programme_region", "dim_programme_immobilier", "region", ("dim_programme_immobilier",))
_measures_query("measures_by_lot_type", "dim_lot_immobilier", "type_lot", ("fact_reservation", "dim_lot_immobilier"))
_measures_query("measures_normalised_lots", "dim_lot_immobilier", "type_lot", ("fact_reservation", "dim_lot_immobilier"), True)
_measures_query("measures_normalised_clients", "dim_investisseur", "ville", ("fact_vente", "fact_financement"), True)


# Roles on the built dimensions

for _role_name, _role in ROLES.items():
    _tests = " OR ".join(f"{c} IN (SELECT {c} FROM grants WHERE {c} IS NOT NULL)" for c in _role.columns)
    _sql = (
        f"{_gold_sql(_role.dimension)}, s_security_user_access AS ({silver_sql('security_user_access')}), access AS ({_access_sql()}), "
        "grants AS (SELECT * FROM access WHERE user_email = 'user1@example.com' AND is_active) "
        f"SELECT * FROM {_role.dimension} WHERE {_tests} OR EXISTS (SELECT 1 FROM grants WHERE access_level IN ('ALL', 'ADV'))"
    )

    @query("role_" + _role.dimension, _sql)
    def _(t: Tables, role=_role):
        model = PropertyModel(t)
        access = access_table(model.silver("security_user_access"))
        return visible(model.dimensions(role.dimension)[role.dimension], role, stored_grants(access, "User1@Example.com"))
