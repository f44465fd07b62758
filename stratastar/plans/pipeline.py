"""Build of all layers, in memory or into stored tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratastar.operators.quality import (
    accepted_values_failures,
    column_failures,
    freshness,
    quality_log,
    run_log,
)
from stratastar.operators.setops import domain_values, observed_dates, union_all
from stratastar.plans import catalogue
from stratastar.plans.gold import dimension, fact
from stratastar.plans.security import access_table
from stratastar.plans.silver import silver_table

Save = Callable[[str, str, DataFrame], DataFrame]


# Columns of silver tables that must be filled, besides the key and the state.
NEVER_NULL = {
    "commissions": ("type_operation",),
    "objectifs_commerciaux": ("annee", "mois"),
    "security_user_access": ("user_email", "role_metier"),
}


def keep(layer: str, name: str, df: DataFrame) -> DataFrame:
    """No storage: consumers extend the plan."""
    return df


def build_silver(bronze: Mapping[str, DataFrame], *, dedup: bool = True, save: Save = keep) -> dict[str, DataFrame]:
    """The silver tables of every source table given."""
    return {
        name: save("silver", name, silver_table(bronze[spec.source], spec, dedup=dedup))
        for name, spec in catalogue.SILVER.items()
        if spec.source in bronze
    }


def build_dimensions(
    silver: Mapping[str, DataFrame],
    *,
    latest: bool = False,
    deleted_policy: str = "after",
    only: set[str] | None = None,
    save: Save = keep,
) -> dict[str, DataFrame]:
    """Dimensions in dependency order; `latest` ranks versions for silver tables that still hold all of them."""
    built: dict[str, DataFrame] = {}
    for name, spec in catalogue.DIMENSIONS.items():
        if only is None or name in only:
            rows = dimension(silver[spec.source], spec, built, latest=latest, deleted_policy=deleted_policy)
            built[name] = save("gold", name, rows)
    if only is None or "dim_date" in only:
        built["dim_date"] = save("gold", "dim_date", observed_dates(catalogue.date_sources(silver)))
    if only is None or "dim_statut" in only:
        domains = {d: (silver[source], column) for d, (source, column) in catalogue.STATUS_DOMAINS.items()}
        built["dim_statut"] = save("gold", "dim_statut", domain_values(domains))
    return built


def build_facts(
    silver: Mapping[str, DataFrame],
    dimensions: Mapping[str, DataFrame],
    *,
    only: Mapping[str, Collection[str]] | None = None,
    save: Save = keep,
) -> dict[str, DataFrame]:
    """All facts; with `only` (columns by fact) just the lookups of keys that are read."""
    read = {name: None if only is None else only.get(name, ()) for name in catalogue.FACTS}
    return {
        name: save("gold", name, fact(silver[spec.source], spec, dimensions, read[name])) for name, spec in catalogue.FACTS.items()
    }


def build_gold(silver: Mapping[str, DataFrame], *, latest: bool = False, save: Save = keep) -> dict[str, DataFrame]:
    dimensions = build_dimensions(silver, latest=latest, save=save)
    facts = build_facts(silver, dimensions, save=save)
    access = save("gold", "security_user_access", access_table(silver["security_user_access"]))
    return {**dimensions, **facts, "security_user_access": access}


def freshness_tables(
    silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]
) -> dict[tuple[str, str], tuple[DataFrame, str]]:
    """Probed tables with their version column: all but the security, date and status tables."""
    probes = {
        ("silver", name): (silver[name], spec.version_order[0])
        for name, spec in catalogue.SILVER.items()
        if name != "security_user_access" and name in silver
    }
    for name, spec in {**catalogue.FACTS, **catalogue.DIMENSIONS}.items():
        if name in gold:
            probes["gold", name] = (gold[name], catalogue.SILVER[spec.source].version_order[0])
    return probes


def build_tech(
    silver: Mapping[str, DataFrame],
    gold: Mapping[str, DataFrame],
    checked_at: Column,
    statements: DataFrame | None = None,
    *,
    environment: str = "DEV",
    save: Save = keep,
) -> dict[str, DataFrame]:
    """Quality log, freshness and, from the statements that ran (see `run_log`), the run log.

    A `save` that appends keeps the history of the logs.
    """
    built = {
        "data_quality_log": save("tech", "data_quality_log", quality_log(gold, catalogue.QUALITY_CHECKS, checked_at)),
        "data_freshness": save("tech", "data_freshness", freshness(freshness_tables(silver, gold), checked_at)),
    }
    if statements is not None:
        built["pipeline_run_log"] = save("tech", "pipeline_run_log", run_log(statements, checked_at, environment=environment))
    return built


def data_tests(
    silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame], tech: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Failures per declared test: table_name, column_name, test, n_failures.

    All never-null and unique tests of a table share one scan and one shuffle; the tables are tested side by side.
    """
    tech = tech or {}
    rows, declared = [], []

    def add(table: str, column: str, test: str, failures: DataFrame) -> None:
        counted = failures.agg(F.count(F.lit(1)).alias("n_failures"))
        rows.append(
            counted.select(
                F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(test).alias("test"), "n_failures"
            )
        )

    def declare(table: str, df: DataFrame, never_null: list[str], unique: list[str]) -> None:
        declared.append((table, df, never_null, unique))

    for name, spec in catalogue.SILVER.items():
        if name in silver:
            state = "is_deleted" if spec.deleted else "is_active"
            unique = [] if name == "security_user_access" else [spec.key]
            declare(name, silver[name], [spec.key, state, *NEVER_NULL.get(name, ())], unique)
    for name, spec in {**catalogue.DIMENSIONS, **catalogue.FACTS}.items():
        if name in gold:
            declare(name, gold[name], *catalogue.required_columns(spec))
    if "dim_date" in gold:
        declare("dim_date", gold["dim_date"], ["date_key", "full_date"], ["date_key"])
    if "dim_statut" in gold:
        declare("dim_statut", gold["dim_statut"], ["statut_key", "domaine_statut", "statut_value"], ["statut_key"])
        domains = accepted_values_failures(gold["dim_statut"], "domaine_statut", list(catalogue.STATUS_DOMAINS))
        add("dim_statut", "domaine_statut", "accepted_values", domains)
    if "security_user_access" in gold:
        declare(
            "gold_security_user_access",
            gold["security_user_access"],
            ["security_access_key", "user_email", "role_metier"],
            ["security_access_key"],
        )
    for name, (never_null, unique, accepted) in catalogue.TECH_TESTS.items():
        if name in tech:
            declare(name, tech[name], list(never_null), list(unique))
            for column, values in accepted.items():
                add(name, column, "accepted_values", accepted_values_failures(tech[name], column, values))
    with ThreadPoolExecutor(max_workers=8) as pool:
        tested = pool.map(lambda d: column_failures(*d[1:]).select(F.lit(d[0]).alias("table_name"), "*"), declared)
        return union_all([*rows, *tested])
