"""The full model on the smallest tables: stored build, invariants, roles, measures."""

from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratastar.examples import Tables
from stratastar.examples.property_model import PropertyModel, probed_layers
from stratastar.plans import catalogue, pipeline
from stratastar.plans.security import ROLES, Role, access_table, secured, user_grants, visible
from stratastar.plans.semantic import YEAR, Model, Relationship, measure_query, propagate, store_by_year
from stratastar.session import materialise
from stratastar.sources.layout import Layout

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("warehouse")), "test")
    model = PropertyModel(Tables(spark, FOLDER))
    bronze = {s.source: layout.save("bronze", s.source, model.bronze(n)) for n, s in catalogue.SILVER.items()}
    silver = pipeline.build_silver(bronze, save=layout.save)
    gold = pipeline.build_gold(silver, save=layout.save)
    return bronze, silver, gold


def test_counts_of_the_model():
    assert len(catalogue.SILVER) == 22 and sum(len(s.columns) for s in catalogue.SILVER.values()) == 503
    assert len(catalogue.FACTS) == 10 and len(catalogue.DIMENSIONS) == 7 and len(catalogue.STATUS_DOMAINS) == 10
    assert sum(len(f.lookups) + bool(f.status) for f in catalogue.FACTS.values()) == 51
    assert len(catalogue.relationships()) == 61 and len(catalogue.measures()) == 44
    assert len(catalogue.QUALITY_CHECKS) == 13


def test_facts_keep_their_rows_and_every_key_resolves(layers):
    _, silver, gold = layers
    for name, spec in catalogue.FACTS.items():
        column, value = spec.live
        assert gold[name].count() == silver[spec.source].where(F.col(column) == value).count()
    for edge in catalogue.relationships():
        members = gold[edge.dimension].select(F.col(edge.key).alias("pk"))
        known = gold[edge.table].where(F.col(edge.foreign_key).isNotNull())
        assert known.join(members, F.col(edge.foreign_key) == F.col("pk"), "left_anti").isEmpty(), edge
        if edge.dimension != "dim_date":
            assert gold[edge.table].where(F.col(edge.foreign_key).isNull()).isEmpty(), edge


def test_each_dimension_has_one_unknown_member(layers):
    gold = layers[2]
    for name, spec in catalogue.DIMENSIONS.items():
        rows = gold[name].where(F.col(spec.natural_key) == "__UNKNOWN__").collect()
        assert len(rows) == 1
        assert rows[0][spec.key] == hashlib.sha256(b"__UNKNOWN__").hexdigest()
    adviser = gold["dim_conseiller"].where("conseiller_id = '__UNKNOWN__'").first()
    assert (adviser.nom, adviser.prenom, adviser.statut_collaborateur, adviser.is_active) == ("Conseiller inconnu", None, "INCONNU", True)
    assert adviser.agence_region_key == adviser.conseiller_key and adviser.region_id == "__UNKNOWN__"
    lot = gold["dim_lot_immobilier"].where("lot_id = '__UNKNOWN__'").first()
    assert (lot.numero_lot, lot.parking_inclus, lot.surface_m2) == ("Lot inconnu", False, None)


def test_declared_tests_pass_where_the_build_guarantees_them(layers):
    _, silver, gold = layers
    failures = [r for r in pipeline.data_tests(silver, gold).collect() if r.n_failures]
    # Only columns that the source leaves empty may fail.
    assert {(r.table_name, r.column_name) for r in failures} <= {
        ("commissions", "type_operation"),
        ("objectifs_commerciaux", "annee"),
        ("objectifs_commerciaux", "mois"),
        ("security_user_access", "role_metier"),
        ("gold_security_user_access", "role_metier"),
        ("fact_vente", "prix_vente_ttc"),
        ("fact_souscription_pierre_papier", "montant_souscrit"),
    }


def test_undeduplicated_silver_gives_the_same_dimensions(spark, layers):
    bronze, silver, gold = layers
    every = pipeline.build_silver(bronze, dedup=False)
    assert every["lots_immobiliers"].count() > silver["lots_immobiliers"].count()
    again = pipeline.build_dimensions(every, latest=True, only={"dim_programme_immobilier", "dim_lot_immobilier"})
    for name, df in again.items():
        assert df.exceptAll(gold[name].select(*df.columns)).isEmpty() and df.count() == gold[name].count()


def test_technical_tables(layers):
    _, silver, gold = layers
    tech = pipeline.build_tech(silver, gold, F.lit("2026-01-01").cast("timestamp_ntz"))
    assert tech["data_freshness"].count() == 38 and tech["data_quality_log"].count() == 13
    assert {r.status for r in tech["data_quality_log"].collect()} <= {"pass", "warn", "fail"}


def test_all_measures_together(layers):
    gold = layers[2]
    names = [m for m in catalogue.measures()]
    row = measure_query(catalogue.model(gold, normalised=True), names).first()
    assert row["Nb Ventes"] == gold["fact_vente"].count()
    assert row["CA Moyen Vente"] == pytest.approx(float(row["CA Signé"]) / row["Nb Ventes"])
    assert row["Ventes Sans Investisseur"] > 0 and row["Financements Refusés"] > 0
    literal = measure_query(catalogue.model(gold), names).first()
    assert literal["Ventes Sans Investisseur"] is None and literal["Financements Refusés"] is None


def test_ratio_without_denominator_is_blank(layers):
    gold = dict(layers[2])
    gold["fact_reservation"] = gold["fact_reservation"].where("1 = 0")
    row = measure_query(catalogue.model(gold), ["Nb Ventes", "Nb Réservations", "Taux Réservation Vente"]).first()
    assert row["Nb Réservations"] is None and row["Taux Réservation Vente"] is None and row["Nb Ventes"] > 0


def test_unreachable_dimension_repeats_the_total(layers):
    gold = layers[2]
    rows = measure_query(catalogue.model(gold), ["Nb Ventes", "Nb Lots"], [("dim_date", "annee")]).collect()
    assert len(rows) > 1 and {r["Nb Lots"] for r in rows} == {gold["dim_lot_immobilier"].count()}
    with pytest.raises(ValueError):
        measure_query(catalogue.model(gold), ["Nb Lots"], [("dim_date", "annee")])


ACCESS = (
    "user_access_id string, user_email string, user_name string, role_metier string, access_level string, "
    "region_id string, agence_id string, conseiller_id string, partenaire_id string, can_view_commissions boolean, "
    "can_view_margin boolean, can_view_personal_data boolean, can_export_data boolean, start_date date, end_date date, "
    "is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
)


def grant(n, email, level, region=None, agency=None, adviser=None, partner=None, active=True, day=1):
    at = datetime(2025, 1, day)
    return (str(n), email, None, "role", level, region, agency, adviser, partner, None, None, None, None, None, None, active, at, at)


@pytest.fixture(scope="module")
def access(spark):
    rows = [
        grant(1, " Boss@X.com ", "all"),
        grant(2, "adv@x.com", "ADV"),
        grant(3, "region@x.com", "scope", region="R1"),
        grant(4, "agency@x.com", "scope", agency="A2", region=""),
        grant(5, "adviser@x.com", "scope", adviser="C3"),
        grant(6, "partner@x.com", "scope", partner="P1"),
        grant(7, "gone@x.com", "all", active=False),
        grant(8, "  ", "all"),
        grant(9, None, "all"),
        grant(10, "agency@x.com", "SCOPE", agency="A2", day=2),
    ]
    return access_table(spark.createDataFrame(rows, ACCESS))


def test_access_table(access):
    rows = {r.user_access_id: r for r in access.collect()}
    assert set(rows) == {"1", "2", "3", "5", "6", "7", "10"}  # 4 is an older duplicate of 10
    assert rows["1"].user_email == "boss@x.com" and rows["1"].access_level == "ALL"
    assert rows["1"].can_view_margin is False and rows["10"].region_id is None


@pytest.mark.parametrize(
    ("email", "seen"),
    [
        ("BOSS@x.com", {"C1", "C2", "C3", "C4"}),
        ("adv@x.com", {"C1", "C2", "C3", "C4"}),
        ("region@x.com", {"C1"}),
        ("agency@x.com", {"C2"}),
        ("adviser@x.com", {"C3"}),
        ("partner@x.com", set()),
        ("gone@x.com", set()),
        ("nobody@x.com", set()),
    ],
)
def test_roles(spark, access, email, seen):
    advisers = spark.createDataFrame(
        [("C1", "A1", "R1"), ("C2", "A2", "R2"), ("C3", None, None), ("C4", "A4", "R4")], "conseiller_id string, agence_id string, region_id string"
    )
    found = visible(advisers, ROLES["RLS_conseillers"], user_grants(access, email))
    assert {r.conseiller_id for r in found.collect()} == seen
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_roles_reach_the_facts(spark, layers):
    gold = layers[2]
    model = catalogue.model(gold)
    agency = gold["dim_agence_region"].where("agence_id <> '__UNKNOWN__'").first()
    access = access_table(spark.createDataFrame([grant(1, "u@x.com", "scope", agency=agency.agence_id)], ACCESS))
    role = ROLES["RLS_region/agence"]
    filters = secured(gold, access, "U@x.com", [role])
    assert list(filters) == ["dim_agence_region"]
    kept = propagate(model, "fact_vente", filters)
    assert kept.count() == gold["fact_vente"].where(F.col("agence_region_key") == agency.agence_region_key).count()
    # A second role leaves the agencies unfiltered, and roles add up.
    assert secured(gold, access, "U@x.com", [role, Role("dim_conseiller", ("agence_id",))]) == {}


def test_a_date_filter_opens_only_its_years(spark, tmp_path):
    rows = [(n, None if n % 50 == 0 else 20200101 + 10000 * (n % 5) + n % 28) for n in range(2000)]
    fact = spark.createDataFrame(rows, "id int, date_key int")
    stored = store_by_year(fact, "date_key", str(tmp_path / "f"))
    days = spark.createDataFrame([(k, k // 10000) for k in sorted({k for _, k in rows if k})], "date_key int, annee int")
    days = materialise(days, "days")
    model = Model({"fact": stored, "dim_date": days}, [Relationship("fact", "date_key", "dim_date", "date_key")], {}, by_year={"fact": "date_key"})
    # Files that no reader could open: the query succeeds only if they stay closed.
    for folder in (tmp_path / "f").glob(f"{YEAR}=*"):
        if not folder.name.endswith("=2022"):
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"closed")
                file.with_name(f".{file.name}.crc").unlink()
    kept = propagate(model, "fact", {"dim_date": days.where("annee = 2022")})
    assert sorted(r.id for r in kept.collect()) == [n for n, k in rows if k and k // 10000 == 2022]


def test_layers_hold_what_is_read(spark):
    """Measured tables are built from silver rows that hold only the columns that are read, with the same values."""
    model = PropertyModel(Tables(spark, FOLDER))
    some = model.silver_of({"commissions": {"commission_id", "motif_blocage"}})["commissions"]
    assert some.columns == ["commission_id", "updated_at", "motif_blocage"]
    assert sorted(map(str, some.collect())) == sorted(map(str, model.silver("commissions").select(*some.columns).collect()))
    built = model.facts("fact_commission", reads={"fact_commission": {"motif_blocage", "conseiller_key"}})
    assert "commentaire" not in " ".join(built["fact_commission"].columns) and len(built["fact_commission"].columns) < 10
    assert built["fact_commission"].count() == model.fact("fact_commission").count()


def test_freshness_stores_no_keys_that_nobody_reads(spark):
    """Row counts and newest times of all layers, without foreign keys, dates and statuses of facts."""
    silver, gold = probed_layers(Tables(spark, FOLDER))
    assert silver["commissions"].columns == ["commission_id", "updated_at", "is_deleted"] and "dim_statut" not in gold
    whole = PropertyModel(Tables(spark, FOLDER)).fact("fact_commission")
    assert gold["fact_commission"].agg(F.count("*"), F.max("updated_at")).first() == whole.agg(F.count("*"), F.max("updated_at")).first()
    assert set(pipeline.freshness_tables(silver, gold)) == {("silver", n) for n in catalogue.SILVER if n != "security_user_access"} | {
        ("gold", n) for n in [*catalogue.FACTS, *catalogue.DIMENSIONS]
    }
