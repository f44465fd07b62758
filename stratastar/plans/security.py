"""Row-level security: access table, grants, roles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratastar.functions.cleaning import blank_to_null, clean_code, clean_lower, id_text
from stratastar.functions.keys import surrogate_key
from stratastar.operators.versions import latest_version
from stratastar.session import materialise

# Access levels that see everything, and the texts for an absent scope.
BYPASS_LEVELS = ("ALL", "ADV")
NO_SCOPE = {
    "region_id": "NO_REGION",
    "agence_id": "NO_AGENCE",
    "conseiller_id": "NO_CONSEILLER",
    "partenaire_id": "NO_PARTENAIRE",
}
RIGHTS = ("can_view_commissions", "can_view_margin", "can_view_personal_data", "can_export_data")
GRANT_KEY = ("user_email", "role_metier", "access_level", *NO_SCOPE)


@dataclass(frozen=True)
class Role:
    """Rows of `dimension` are visible when one of `columns` holds a granted value."""

    dimension: str
    columns: tuple[str, ...]


# The scope columns of the three roles.
ROLES = {
    "RLS_conseillers": Role("dim_conseiller", ("region_id", "agence_id", "conseiller_id")),
    "RLS_investisseur": Role("dim_investisseur", ("agence_id", "conseiller_id", "partenaire_id")),
    "RLS_region/agence": Role("dim_agence_region", ("region_id", "agence_id")),
}


def access_table(access: DataFrame) -> DataFrame:
    """Cleaned grants, newest per (user, role, level, scope), with a hash key over those seven."""
    shaped = access.withColumns(
        {
            "user_access_id": id_text("user_access_id"),
            "user_email": clean_lower("user_email"),
            "user_name": id_text("user_name"),
            "role_metier": clean_code("role_metier"),
            "access_level": clean_code("access_level"),
            **{scope: blank_to_null(id_text(scope)) for scope in NO_SCOPE},
            **{right: F.coalesce(F.col(right), F.lit(False)) for right in RIGHTS},
            "is_active": F.coalesce(F.col("is_active"), F.lit(True)),
        }
    ).where(F.col("user_email").isNotNull() & (F.col("user_email") != ""))
    newest = latest_version(
        shaped,
        GRANT_KEY,
        ["updated_at", "created_at"],
        tie_break=["user_access_id"],
        placeholders=NO_SCOPE,
        keep_null_keys=True,  # a grant without a role or level is a grant of its own
    )
    return newest.select(surrogate_key(*GRANT_KEY).alias("security_access_key"), *newest.columns)


def user_grants(access: DataFrame, email: str) -> DataFrame:
    """Active grants of a user; the address matches in any case."""
    return access.where((F.lower("user_email") == email.lower()) & F.col("is_active"))


def stored_grants(access: DataFrame, email: str) -> DataFrame:
    """The user's grants, stored: a few rows that every rule reads, instead of deduplicating the
    access table once per scope. With their size known, each scope becomes a broadcast join."""
    return materialise(user_grants(access, email), "grants")


def bypasses(grants: DataFrame, levels: Sequence[str] = BYPASS_LEVELS) -> Column:
    """True when a grant opens everything."""
    return grants.where(F.col("access_level").isin(*levels)).select(F.lit(1)).exists()


def visible(dimension: DataFrame, role: Role, grants: DataFrame) -> DataFrame:
    """Rows of a dimension that the role shows to the holder of the grants.

    Each scope is an IN over the granted values. Spark runs it as a hash join on that
    column, so no scope needs its own pass over the dimension and no pair is formed.
    """
    scopes = [
        F.coalesce(F.col(column).isin(grants.where(F.col(column).isNotNull()).select(column)), F.lit(False))
        for column in role.columns
    ]
    return dimension.where(reduce(lambda a, b: a | b, scopes, bypasses(grants)))


def secured(
    dimensions: Mapping[str, DataFrame], access: DataFrame, email: str, roles: Sequence[Role]
) -> dict[str, DataFrame]:
    """Filtered dimensions for a user who holds `roles`, ready for `propagate`.

    Roles add up: a row is visible if any role shows it, and a role without a filter on a
    dimension shows all of it. So a dimension is filtered only if every role filters it, and
    the others are not in the result. Store the results before filtering large facts: with a
    known size a short list of visible rows is broadcast, and the fact is not shuffled.
    """
    grants = stored_grants(access, email)
    result: dict[str, DataFrame] = {}
    for name in dict.fromkeys(role.dimension for role in roles):
        if any(role.dimension != name for role in roles):
            continue
        columns = dict.fromkeys(c for role in roles for c in role.columns)
        result[name] = visible(dimensions[name], Role(name, tuple(columns)), grants)
    return result
