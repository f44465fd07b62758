"""The property-investment model: source tables, star, relationships, measures.

Column, table and measure names are fixed values: queries address them by name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratastar.functions.keys import date_key, month_start, surrogate_key, unknown_key
from stratastar.operators.lookup import Lookup
from stratastar.operators.quality import Check
from stratastar.plans.semantic import Measure, Model, Relationship
from stratastar.plans.specs import DimensionSpec, FactSpec, SilverSpec


def _table(
    name: str,
    key: str,
    columns: Sequence[tuple[str, str]],
    *,
    version_order: tuple[str, ...] = ("updated_at", "created_at"),
    deleted: str | None = None,
) -> SilverSpec:
    return SilverSpec(name, key, dict(columns), version_order, deleted)


# The 22 source tables, each with its columns and their kinds in the order of the source.
SILVER = {
    spec.name: spec
    for spec in (
        _table(
            "agences_regions",
            "agence_id",
            (
                ("agence_id", "id"),
                ("nom_agence", "text"),
                ("code_agence", "code"),
                ("region_id", "id"),
                ("nom_region", "text"),
                ("directeur_region_id", "id"),
                ("responsable_agence_id", "id"),
                ("ville", "text"),
                ("code_postal", "text"),
                ("adresse", "text"),
                ("pays", "code"),
                ("zone_commerciale", "text"),
                ("statut_agence", "code"),
                ("date_ouverture", "date"),
                ("date_fermeture", "date"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_active", "flag"),
            ),
        ),
        _table(
            "commissions",
            "commission_id",
            (
                ("commission_id", "id"),
                ("type_operation", "code"),
                ("operation_id", "id"),
                ("vente_id", "id"),
                ("souscription_id", "id"),
                ("operation_crowdfunding_id", "id"),
                ("investisseur_id", "id"),
                ("partenaire_id", "id"),
                ("conseiller_id", "id"),
                ("agence_id", "id"),
                ("produit_id", "id"),
                ("programme_id", "id"),
                ("montant_operation", "18,2"),
                ("taux_commission", "9,4"),
                ("montant_commission_brut", "18,2"),
                ("montant_commission_net", "18,2"),
                ("part_commission_partenaire", "18,2"),
                ("part_commission_interne", "18,2"),
                ("statut_commission", "code"),
                ("date_calcul", "date"),
                ("date_validation", "date"),
                ("date_paiement", "date"),
                ("mode_paiement", "code"),
                ("motif_blocage", "text"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
        _table(
            "conseillers",
            "conseiller_id",
            (
                ("conseiller_id", "id"),
                ("matricule", "code"),
                ("nom", "text"),
                ("prenom", "text"),
                ("email", "lower"),
                ("telephone", "text"),
                ("poste", "text"),
                ("agence_id", "id"),
                ("region_id", "id"),
                ("manager_id", "id"),
                ("date_arrivee", "date"),
                ("date_depart", "date"),
                ("statut_collaborateur", "code"),
                ("specialite_produit", "text"),
                ("objectif_annuel", "18,2"),
                ("objectif_mensuel_moyen", "18,2"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_active", "flag"),
            ),
        ),
        _table(
            "crm_investisseurs",
            "investisseur_id",
            (
                ("investisseur_id", "id"),
                ("prospect_id", "id"),
                ("civilite", "code"),
                ("nom", "text"),
                ("prenom", "text"),
                ("email", "lower"),
                ("telephone", "text"),
                ("adresse", "text"),
                ("ville", "text"),
                ("code_postal", "text"),
                ("pays", "code"),
                ("profession", "text"),
                ("situation_familiale", "code"),
                ("revenu_annuel", "18,2"),
                ("patrimoine_financier", "18,2"),
                ("patrimoine_immobilier", "18,2"),
                ("profil_investisseur", "code"),
                ("objectif_principal", "text"),
                ("horizon_placement", "text"),
                ("niveau_experience", "code"),
                ("statut_kyc", "code"),
                ("statut_lcbft", "code"),
                ("date_entree_relation", "date"),
                ("partenaire_id", "id"),
                ("conseiller_id", "id"),
                ("agence_id", "id"),
                ("statut_client", "code"),
                ("date_creation", "timestamp"),
                ("created_by", "text"),
                ("last_update_date", "timestamp"),
                ("last_updated_by", "text"),
                ("is_deleted", "flag"),
            ),
            version_order=("last_update_date", "date_creation"),
            deleted="is_deleted",
        ),
        _table(
            "crm_prospects",
            "prospect_id",
            (
                ("prospect_id", "id"),
                ("civilite", "code"),
                ("nom", "text"),
                ("prenom", "text"),
                ("email", "lower"),
                ("telephone", "text"),
                ("date_naissance", "date"),
                ("ville", "text"),
                ("code_postal", "text"),
                ("pays", "code"),
                ("situation_familiale", "code"),
                ("profession", "text"),
                ("revenu_annuel_estime", "18,2"),
                ("patrimoine_estime", "18,2"),
                ("capacite_investissement", "18,2"),
                ("objectif_investissement", "text"),
                ("horizon_investissement", "text"),
                ("appetence_risque", "code"),
                ("source_acquisition", "text"),
                ("campagne_marketing", "text"),
                ("canal_acquisition", "code"),
                ("statut_prospect", "code"),
                ("score_qualification", "int"),
                ("date_creation", "timestamp"),
                ("created_by", "text"),
                ("last_update_date", "timestamp"),
                ("last_updated_by", "text"),
                ("is_deleted", "flag"),
            ),
            version_order=("last_update_date", "date_creation"),
            deleted="is_deleted",
        ),
        _table(
            "dossiers_adv",
            "dossier_adv_id",
            (
                ("dossier_adv_id", "id"),
                ("vente_id", "id"),
                ("reservation_id", "id"),
                ("investisseur_id", "id"),
                ("lot_id", "id"),
                ("programme_id", "id"),
                ("partenaire_id", "id"),
                ("conseiller_id", "id"),
                ("statut_dossier", "code"),
                ("date_ouverture_dossier", "date"),
                ("date_reception_pieces", "date"),
                ("date_validation_dossier", "date"),
                ("date_envoi_notaire", "date"),
                ("date_signature_acte", "date"),
                ("delai_traitement_jours", "int"),
                ("pieces_manquantes", "flag"),
                ("nombre_relances", "int"),
                ("blocage_adv", "flag"),
                ("motif_blocage", "text"),
                ("responsable_adv_id", "id"),
                ("commentaire_adv", "text"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
        _table(
            "evenements_clients",
            "evenement_id",
            (
                ("evenement_id", "id"),
                ("investisseur_id", "id"),
                ("prospect_id", "id"),
                ("partenaire_id", "id"),
                ("conseiller_id", "id"),
                ("type_evenement", "code"),
                ("canal_evenement", "code"),
                ("objet_evenement", "text"),
                ("date_evenement", "timestamp"),
                ("statut_evenement", "code"),
                ("resultat_evenement", "text"),
                ("prochaine_action", "text"),
                ("date_prochaine_action", "timestamp"),
                ("priorite", "code"),
                ("commentaire", "text"),
                ("created_at", "timestamp"),
                ("created_by", "text"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
        _table(
            "expertise_comptable_lmnp",
            "dossier_comptable_id",
            (
                ("dossier_comptable_id", "id"),
                ("investisseur_id", "id"),
                ("vente_id", "id"),
                ("lot_id", "id"),
                ("programme_id", "id"),
                ("annee_fiscale", "int"),
                ("regime_fiscal", "code"),
                ("statut_dossier_comptable", "code"),
                ("date_ouverture", "date"),
                ("date_reception_documents", "date"),
                ("date_declaration", "date"),
                ("recettes_locatives", "18,2"),
                ("charges_deductibles", "18,2"),
                ("amortissements", "18,2"),
                ("resultat_fiscal", "18,2"),
                ("impot_estime", "18,2"),
                ("comptable_id", "id"),
                ("nombre_relances", "int"),
                ("pieces_manquantes", "flag"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
        _table(
            "financements",
            "financement_id",
            (
                ("financement_id", "id"),
                ("vente_id", "id"),
                ("investisseur_id", "id"),
                ("banque", "code"),
                ("courtier", "text"),
                ("montant_demande", "18,2"),
                ("montant_accorde", "18,2"),
                ("taux_credit", "9,4"),
                ("duree_credit_mois", "int"),
                ("mensualite_estimee", "18,2"),
                ("statut_financement", "code"),
                ("date_demande", "date"),
                ("date_accord_principe", "date"),
                ("date_offre_pret", "date"),
                ("date_acceptation_offre", "date"),
                ("motif_refus", "text"),
                ("apport_personnel", "18,2"),
                ("assurance_emprunteur", "18,2"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
        _table(
            "gestion_locative",
            "gestion_id",
            (
                ("gestion_id", "id"),
                ("vente_id", "id"),
                ("lot_id", "id"),
                ("investisseur_id", "id"),
                ("programme_id", "id"),
                ("gestionnaire_id", "id"),
                ("date_debut_gestion", "date"),
                ("date_fin_gestion", "date"),
                ("statut_gestion", "code"),
                ("loyer_mensuel_prevu", "18,2"),
                ("loyer_mensuel_reel", "18,2"),
                ("taux_occupation", "9,4"),
                ("vacance_locative_jours", "int"),
                ("charges_mensuelles", "18,2"),
                ("incident_locatif", "flag"),
                ("montant_impayes", "18,2"),
                ("rendement_reel_annuel", "9,4"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_active", "flag"),
            ),
        ),
        _table(
            "lots_immobiliers",
            "lot_id",
            (
                ("lot_id", "id"),
                ("programme_id", "id"),
                ("numero_lot", "code"),
                ("type_lot", "code"),
                ("typologie", "code"),
                ("surface_m2", "10,2"),
                ("etage", "int"),
                ("orientation", "code"),
                ("parking_inclus", "flag"),
                ("prix_catalogue", "18,2"),
                ("prix_remise", "18,2"),
                ("prix_final", "18,2"),
                ("loyer_estime_mensuel", "18,2"),
                ("rentabilite_brute_estimee", "9,4"),
                ("statut_lot", "code"),
                ("date_disponibilite", "date"),
                ("date_reservation", "date"),
                ("date_vente", "date"),
                ("investisseur_id", "id"),
                ("partenaire_id", "id"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_active", "flag"),
            ),
        ),
        _table(
            "objectifs_commerciaux",
            "objectif_id",
            (
                ("objectif_id", "id"),
                ("annee", "int"),
                ("mois", "int"),
                ("periode", "text"),
                ("niveau_objectif", "code"),
                ("region_id", "id"),
                ("agence_id", "id"),
                ("conseiller_id", "id"),
                ("partenaire_id", "id"),
                ("famille_produit", "code"),
                ("type_produit", "code"),
                ("objectif_ca", "18,2"),
                ("objectif_nombre_ventes", "int"),
                ("objectif_nombre_reservations", "int"),
                ("objectif_montant_souscriptions", "18,2"),
                ("objectif_commissions", "18,2"),
                ("objectif_nouveaux_clients", "int"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_active", "flag"),
            ),
        ),
        _table(
            "operations_crowdfunding",
            "operation_crowdfunding_id",
            (
                ("operation_crowdfunding_id", "id"),
                ("investisseur_id", "id"),
                ("partenaire_id", "id"),
                ("conseiller_id", "id"),
                ("agence_id", "id"),
                ("projet_id", "id"),
                ("nom_projet", "text"),
                ("promoteur_id", "id"),
                ("ville", "text"),
                ("region", "text"),
                ("date_investissement", "date"),
                ("montant_investi", "18,2"),
                ("taux_rendement_annuel_prevu", "9,4"),
                ("duree_mois", "int"),
                ("statut_operation", "code"),
                ("date_remboursement_prevue", "date"),
                ("date_remboursement_reelle", "date"),
                ("montant_rembourse", "18,2"),
                ("interets_bruts", "18,2"),
                ("fiscalite_appliquee", "code"),
                ("incident_paiement", "flag"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
        _table(
            "partenaires_patrimoine",
            "partenaire_id",
            (
                ("partenaire_id", "id"),
                ("raison_sociale", "text"),
                ("siret", "text"),
                ("type_partenaire", "code"),
                ("statut_partenaire", "code"),
                ("nom_contact_principal", "text"),
                ("prenom_contact_principal", "text"),
                ("email_contact", "lower"),
                ("telephone_contact", "text"),
                ("adresse", "text"),
                ("ville", "text"),
                ("code_postal", "text"),
                ("region", "text"),
                ("pays", "code"),
                ("date_signature_convention", "date"),
                ("niveau_partenaire", "code"),
                ("segment_partenaire", "code"),
                ("nombre_clients_actifs", "int"),
                ("encours_total_apporte", "18,2"),
                ("commission_rate_default", "9,4"),
                ("manager_interne_id", "id"),
                ("conseiller_referent_id", "id"),
                ("statut_convention", "code"),
                ("date_derniere_activite", "date"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_active", "flag"),
            ),
        ),
        _table(
            "produits_investissement",
            "produit_id",
            (
                ("produit_id", "id"),
                ("nom_produit", "text"),
                ("famille_produit", "code"),
                ("type_produit", "code"),
                ("sous_type_produit", "code"),
                ("fiscalite", "code"),
                ("niveau_risque", "code"),
                ("duree_recommandee", "text"),
                ("rendement_cible_annuel", "9,4"),
                ("montant_minimum_investissement", "18,2"),
                ("frais_entree", "9,4"),
                ("frais_gestion_annuels", "9,4"),
                ("frais_sortie", "9,4"),
                ("societe_gestion_id", "id"),
                ("promoteur_id", "id"),
                ("statut_commercialisation", "code"),
                ("date_debut_commercialisation", "date"),
                ("date_fin_commercialisation", "date"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_active", "flag"),
            ),
        ),
        _table(
            "programmes_immobiliers",
            "programme_id",
            (
                ("programme_id", "id"),
                ("nom_programme", "text"),
                ("type_programme", "code"),
                ("promoteur_id", "id"),
                ("ville", "text"),
                ("code_postal", "text"),
                ("region", "text"),
                ("adresse", "text"),
                ("latitude", "10,6"),
                ("longitude", "10,6"),
                ("type_actif", "code"),
                ("segment_marche", "code"),
                ("statut_programme", "code"),
                ("date_lancement_commercial", "date"),
                ("date_livraison_prevue", "date"),
                ("date_livraison_reelle", "date"),
                ("nombre_lots_total", "int"),
                ("nombre_lots_disponibles", "int"),
                ("prix_moyen_m2", "18,2"),
                ("rentabilite_cible", "9,4"),
                ("zone_fiscale", "code"),
                ("dispositif_fiscal", "code"),
                ("label_energetique", "code"),
                ("note_programme", "5,2"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_active", "flag"),
            ),
        ),
        _table(
            "reclamations_incidents",
            "reclamation_id",
            (
                ("reclamation_id", "id"),
                ("investisseur_id", "id"),
                ("partenaire_id", "id"),
                ("operation_id", "id"),
                ("type_operation", "code"),
                ("type_reclamation", "code"),
                ("categorie_reclamation", "code"),
                ("niveau_urgence", "code"),
                ("statut_reclamation", "code"),
                ("date_ouverture", "date"),
                ("date_resolution", "date"),
                ("delai_resolution_jours", "int"),
                ("responsable_traitement_id", "id"),
                ("motif_reclamation", "text"),
                ("resolution_apportee", "text"),
                ("impact_financier_estime", "18,2"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
        _table(
            "reservations_immobilieres",
            "reservation_id",
            (
                ("reservation_id", "id"),
                ("lot_id", "id"),
                ("programme_id", "id"),
                ("investisseur_id", "id"),
                ("partenaire_id", "id"),
                ("conseiller_id", "id"),
                ("agence_id", "id"),
                ("date_reservation", "date"),
                ("montant_reservation", "18,2"),
                ("prix_reserve", "18,2"),
                ("remise_appliquee", "18,2"),
                ("statut_reservation", "code"),
                ("motif_annulation", "text"),
                ("date_annulation", "date"),
                ("date_expiration_reservation", "date"),
                ("canal_reservation", "code"),
                ("mode_financement_prevu", "code"),
                ("apport_prevu", "18,2"),
                ("montant_credit_prevu", "18,2"),
                ("commentaire_commercial", "text"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
        _table(
            "revente_biens",
            "revente_id",
            (
                ("revente_id", "id"),
                ("vente_id", "id"),
                ("lot_id", "id"),
                ("investisseur_id", "id"),
                ("programme_id", "id"),
                ("date_demande_revente", "date"),
                ("date_mise_en_marche", "date"),
                ("date_revente", "date"),
                ("prix_achat_initial", "18,2"),
                ("prix_revente_estime", "18,2"),
                ("prix_revente_final", "18,2"),
                ("plus_value_brute", "18,2"),
                ("plus_value_nette", "18,2"),
                ("statut_revente", "code"),
                ("motif_revente", "text"),
                ("mandat_revente", "code"),
                ("conseiller_revente_id", "id"),
                ("nombre_visites", "int"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
        _table(
            "security_user_access",
            "user_access_id",
            (
                ("user_access_id", "id"),
                ("user_email", "lower"),
                ("user_name", "text"),
                ("role_metier", "code"),
                ("access_level", "code"),
                ("region_id", "id"),
                ("agence_id", "id"),
                ("conseiller_id", "id"),
                ("partenaire_id", "id"),
                ("can_view_commissions", "flag"),
                ("can_view_margin", "flag"),
                ("can_view_personal_data", "flag"),
                ("can_export_data", "flag"),
                ("start_date", "date"),
                ("end_date", "date"),
                ("is_active", "flag"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
            ),
        ),
        _table(
            "souscriptions_pierre_papier",
            "souscription_id",
            (
                ("souscription_id", "id"),
                ("investisseur_id", "id"),
                ("partenaire_id", "id"),
                ("conseiller_id", "id"),
                ("agence_id", "id"),
                ("produit_id", "id"),
                ("societe_gestion_id", "id"),
                ("type_support", "code"),
                ("nom_support", "text"),
                ("date_souscription", "date"),
                ("montant_souscrit", "18,2"),
                ("nombre_parts", "18,4"),
                ("prix_part", "18,2"),
                ("frais_souscription", "18,2"),
                ("duree_recommandee", "text"),
                ("rendement_previsionnel", "9,4"),
                ("statut_souscription", "code"),
                ("date_validation", "date"),
                ("date_rejet", "date"),
                ("motif_rejet", "text"),
                ("mode_paiement", "code"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
        _table(
            "ventes_immobilieres",
            "vente_id",
            (
                ("vente_id", "id"),
                ("reservation_id", "id"),
                ("lot_id", "id"),
                ("programme_id", "id"),
                ("investisseur_id", "id"),
                ("partenaire_id", "id"),
                ("conseiller_id", "id"),
                ("agence_id", "id"),
                ("date_signature_contrat", "date"),
                ("date_signature_acte", "date"),
                ("date_livraison_prevue", "date"),
                ("date_livraison_reelle", "date"),
                ("prix_vente_ht", "18,2"),
                ("prix_vente_ttc", "18,2"),
                ("tva", "18,2"),
                ("frais_notaire", "18,2"),
                ("montant_total_operation", "18,2"),
                ("mode_financement", "code"),
                ("montant_apport", "18,2"),
                ("montant_credit", "18,2"),
                ("banque_financement", "code"),
                ("statut_vente", "code"),
                ("motif_echec", "text"),
                ("created_at", "timestamp"),
                ("updated_at", "timestamp"),
                ("is_deleted", "flag"),
            ),
            deleted="is_deleted",
        ),
    )
}

# Natural-key stem to (dimension, surrogate key).
_TARGETS = {
    "agence": ("dim_agence_region", "agence_region_key"),
    "partenaire": ("dim_partenaire", "partenaire_key"),
    "programme": ("dim_programme_immobilier", "programme_key"),
    "produit": ("dim_produit_investissement", "produit_key"),
    "conseiller": ("dim_conseiller", "conseiller_key"),
    "lot": ("dim_lot_immobilier", "lot_key"),
    "investisseur": ("dim_investisseur", "investisseur_key"),
}


def _lookups(stems: Sequence[str]) -> tuple[Lookup, ...]:
    return tuple(Lookup(_TARGETS[s][0], f"{s}_id", f"{s}_id", _TARGETS[s][1]) for s in stems)


def _dimension(stem: str, source: str, unknown: Sequence[str], texts: Mapping[str, str | bool], **extra) -> DimensionSpec:
    """`unknown` lists the columns that read INCONNU in the unknown member."""
    name, key = _TARGETS[stem]
    spec = SILVER[source]
    values = {**dict.fromkeys(unknown, "INCONNU"), **texts}
    return DimensionSpec(
        name, source, f"{stem}_id", key, unknown=values, version_order=spec.version_order, deleted=spec.deleted, **extra
    )


# In build order. Texts of the unknown members.
DIMENSIONS = {
    spec.name: spec
    for spec in (
        _dimension(
            "agence",
            "agences_regions",
            ("statut_agence",),
            {
                "nom_agence": "Agence inconnue",
                "code_agence": "__UNKNOWN__",
                "region_id": "__UNKNOWN__",
                "nom_region": "Region inconnue",
                "is_active": True,
            },
        ),
        _dimension(
            "partenaire",
            "partenaires_patrimoine",
            ("type_partenaire", "statut_partenaire", "niveau_partenaire", "segment_partenaire", "statut_convention"),
            {"raison_sociale": "Partenaire inconnu", "is_active": True},
            full_name=("contact_principal", "prenom_contact_principal", "nom_contact_principal"),
        ),
        _dimension(
            "programme",
            "programmes_immobiliers",
            ("type_programme", "type_actif", "segment_marche", "statut_programme"),
            {"nom_programme": "Programme inconnu", "is_active": True},
        ),
        _dimension(
            "produit",
            "produits_investissement",
            ("famille_produit", "type_produit", "sous_type_produit", "statut_commercialisation"),
            {"nom_produit": "Produit inconnu", "is_active": True},
        ),
        _dimension(
            "conseiller",
            "conseillers",
            ("statut_collaborateur",),
            {
                "nom": "Conseiller inconnu",
                "nom_complet": "Conseiller inconnu",
                "region_id": "__UNKNOWN__",
                "is_active": True,
            },
            parents=_lookups(("agence",)),
            full_name=("nom_complet", "prenom", "nom"),
        ),
        _dimension(
            "lot",
            "lots_immobiliers",
            ("type_lot", "typologie", "statut_lot"),
            {"numero_lot": "Lot inconnu", "parking_inclus": False, "is_active": True},
            parents=_lookups(("programme",)),
        ),
        _dimension(
            "investisseur",
            "crm_investisseurs",
            ("profil_investisseur", "statut_client"),
            {"nom": "Investisseur inconnu", "nom_complet": "Investisseur inconnu", "is_deleted": False},
            parents=_lookups(("partenaire", "conseiller", "agence")),
            full_name=("nom_complet", "prenom", "nom"),
        ),
    )
}


def _fact(name: str, source: str, key: str, stems: Sequence[str], date_role: str, status: tuple[str, str] | None = None, **extra) -> FactSpec:
    spec = SILVER[source]
    live = ("is_deleted", False) if spec.deleted else ("is_active", True)
    return FactSpec(name, source, spec.key, key, _lookups(stems), f"{date_role}_key", status, live, **extra)


FACTS = {
    spec.name: spec
    for spec in (
        _fact(
            "fact_vente",
            "ventes_immobilieres",
            "vente_key",
            ("investisseur", "partenaire", "conseiller", "agence", "programme", "lot"),
            "date_signature_acte",
            ("VENTE", "statut_vente"),
        ),
        _fact(
            "fact_reservation",
            "reservations_immobilieres",
            "reservation_key",
            ("investisseur", "partenaire", "conseiller", "agence", "programme", "lot"),
            "date_reservation",
            ("RESERVATION", "statut_reservation"),
            drop=("commentaire_commercial",),
        ),
        _fact(
            "fact_commission",
            "commissions",
            "commission_key",
            ("investisseur", "partenaire", "conseiller", "agence", "produit", "programme"),
            "date_calcul",
            ("COMMISSION", "statut_commission"),
        ),
        _fact(
            "fact_objectif_commercial",
            "objectifs_commerciaux",
            "objectif_key",
            ("agence", "conseiller", "partenaire"),
            "date_objectif",
            drop=("is_active",),
            extra={
                "date_objectif_key": lambda: date_key(month_start("annee", "mois")),
                "produit_objectif_key": lambda: surrogate_key("famille_produit", "type_produit"),
            },
        ),
        _fact(
            "fact_souscription_pierre_papier",
            "souscriptions_pierre_papier",
            "souscription_key",
            ("investisseur", "partenaire", "conseiller", "agence", "produit"),
            "date_souscription",
            ("SOUSCRIPTION", "statut_souscription"),
        ),
        _fact(
            "fact_operation_crowdfunding",
            "operations_crowdfunding",
            "crowdfunding_key",
            ("investisseur", "partenaire", "conseiller", "agence"),
            "date_investissement",
            ("CROWDFUNDING", "statut_operation"),
        ),
        _fact(
            "fact_financement",
            "financements",
            "financement_key",
            ("investisseur",),
            "date_demande",
            ("FINANCEMENT", "statut_financement"),
        ),
        _fact(
            "fact_gestion_locative",
            "gestion_locative",
            "gestion_locative_key",
            ("investisseur", "programme", "lot"),
            "date_debut_gestion",
            ("GESTION_LOCATIVE", "statut_gestion"),
        ),
        _fact(
            "fact_revente",
            "revente_biens",
            "revente_key",
            ("investisseur", "programme", "lot"),
            "date_demande_revente",
            ("REVENTE", "statut_revente"),
        ),
        _fact(
            "fact_dossier_adv",
            "dossiers_adv",
            "dossier_adv_key",
            ("investisseur", "partenaire", "conseiller", "programme", "lot"),
            "date_ouverture_dossier",
            ("DOSSIER_ADV", "statut_dossier"),
        ),
    )
}

# Domain of every status column in the status dimension: (silver table, column).
STATUS_DOMAINS = {spec.status[0]: (spec.source, spec.status[1]) for spec in FACTS.values() if spec.status} | {
    "RECLAMATION": ("reclamations_incidents", "statut_reclamation")
}


def date_sources(silver: Mapping[str, DataFrame]) -> list[tuple[DataFrame, list[str | Column]]]:
    """Every date column that some fact turns into a key, for the sources given."""
    sources: list[tuple[DataFrame, list[str | Column]]] = []
    for spec in FACTS.values():
        if spec.source not in silver:
            continue
        if spec.source == "objectifs_commerciaux":
            columns: list[str | Column] = [month_start("annee", "mois")]
        else:
            columns = [name for name, kind in SILVER[spec.source].columns.items() if kind == "date"]
        sources.append((silver[spec.source], columns))
    return sources


def relationships() -> list[Relationship]:
    """Every lookup and status of every fact, and its one active date."""
    edges = []
    for spec in FACTS.values():
        edges += [Relationship(spec.name, target.key, target.dimension, target.key) for target in spec.lookups]
        edges.append(Relationship(spec.name, spec.date_role, "dim_date", "date_key"))
        if spec.status:
            edges.append(Relationship(spec.name, "statut_key", "dim_statut", "statut_key"))
    return edges


# Names, aggregates, tables and columns of the measures, and the ratios over them.
BASE_MEASURES = (
    Measure("CA Signé", "sum", "fact_vente", "montant_total_operation"),
    Measure("Nb Ventes", "count", "fact_vente"),
    Measure("Nb Réservations", "count", "fact_reservation"),
    Measure("Objectif CA", "sum", "fact_objectif_commercial", "objectif_ca"),
    Measure("Montant Réservé", "sum", "fact_reservation", "prix_reserve"),
    Measure("Montant Crédit", "sum", "fact_vente", "montant_credit"),
    Measure("Montant Apport", "sum", "fact_vente", "montant_apport"),
    Measure("Nb Programmes", "distinct", "dim_programme_immobilier", "programme_key"),
    Measure("Nb Lots Disponibles", "sum", "dim_programme_immobilier", "nombre_lots_disponibles"),
    Measure("Prix Moyen m2", "avg", "dim_programme_immobilier", "prix_moyen_m2"),
    Measure("Rentabilité Cible Moyenne", "avg", "dim_programme_immobilier", "rentabilite_cible"),
    Measure("Nb Lots", "distinct", "dim_lot_immobilier", "lot_key"),
    Measure("Prix Final Moyen Lot", "avg", "dim_lot_immobilier", "prix_final"),
    Measure("Rentabilité Brute Estimée Moyenne", "avg", "dim_lot_immobilier", "rentabilite_brute_estimee"),
    Measure("Surface Moyenne", "avg", "dim_lot_immobilier", "surface_m2"),
    Measure("Nb Investisseurs", "distinct", "dim_investisseur", "investisseur_key"),
    Measure("Patrimoine Financier Moyen", "avg", "dim_investisseur", "patrimoine_financier"),
    Measure("Patrimoine Immobilier Moyen", "avg", "dim_investisseur", "patrimoine_immobilier"),
    Measure("Revenu Annuel Moyen", "avg", "dim_investisseur", "revenu_annuel"),
    Measure("Commission Brute", "sum", "fact_commission", "montant_commission_brut"),
    Measure("Commission Nette", "sum", "fact_commission", "montant_commission_net"),
    Measure("Part Commission Partenaire", "sum", "fact_commission", "part_commission_partenaire"),
    Measure("Part Commission Interne", "sum", "fact_commission", "part_commission_interne"),
    Measure("Taux Commission Moyen", "avg", "fact_commission", "taux_commission"),
    Measure("Nb Dossiers ADV", "count", "fact_dossier_adv"),
    Measure("Délai Moyen Traitement ADV", "avg", "fact_dossier_adv", "delai_traitement_jours"),
    Measure("Montant Financement Demandé", "sum", "fact_financement", "montant_demande"),
    Measure("Montant Financement Accordé", "sum", "fact_financement", "montant_accorde"),
    Measure("Taux Crédit Moyen", "avg", "fact_financement", "taux_credit"),
    Measure("Taux Occupation Moyen", "avg", "fact_gestion_locative", "taux_occupation"),
    Measure("Montant Impayés", "sum", "fact_gestion_locative", "montant_impayes"),
)
RATIOS = (
    Measure("Taux Réservation Vente", "ratio", numerator="Nb Ventes", denominator="Nb Réservations"),
    Measure("Taux Atteinte Objectif CA", "ratio", numerator="CA Signé", denominator="Objectif CA"),
    Measure("CA Moyen Vente", "ratio", numerator="CA Signé", denominator="Nb Ventes"),
)


def _filtered(normalised: bool) -> list[Measure]:
    """Counts under a condition.

    As written in the business model, some conditions never hold: keys are never
    blank and statuses are upper case. `normalised` tests for the unknown member
    and for upper-case statuses instead.
    """

    def no_member(key: str) -> Column:
        return F.col(key) == unknown_key() if normalised else F.col(key).isNull()

    def status(column: str, text: str, upper: str) -> Column:
        return F.col(column) == (upper if normalised else text)

    def sold_but_available() -> Column:
        return status("statut_lot", "Disponible", "DISPONIBLE") & F.col("date_vente").isNotNull()

    incomplete = lambda: F.col("pieces_manquantes")
    blocked = lambda: F.col("blocage_adv")
    counts = {
        "Nb Dossiers Pièces Manquantes": ("fact_dossier_adv", "pieces_manquantes", incomplete),
        "Nb Dossiers Bloqués": ("fact_dossier_adv", "blocage_adv", blocked),
        "Ventes Sans Date Acte": ("fact_vente", "date_signature_acte_key", lambda: F.col("date_signature_acte_key").isNull()),
        "Ventes Sans Investisseur": ("fact_vente", "investisseur_key", lambda: no_member("investisseur_key")),
        "Réservations Sans Lot": ("fact_reservation", "lot_key", lambda: no_member("lot_key")),
        "Commissions Bloquées": ("fact_commission", "motif_blocage", lambda: F.col("motif_blocage").isNotNull()),
        "Dossiers ADV Bloqués": ("fact_dossier_adv", "blocage_adv", blocked),
        "Dossiers Pièces Manquantes": ("fact_dossier_adv", "pieces_manquantes", incomplete),
        "Financements Refusés": ("fact_financement", "statut_financement", lambda: status("statut_financement", "Refusé", "REFUSE")),
    }
    result = [Measure(name, "count", table, where=where, reads=(column,)) for name, (table, column, where) in counts.items()]
    result.append(
        Measure(
            "Lots Vendus Encore Disponibles", "distinct", "dim_lot_immobilier", "lot_key", sold_but_available, reads=("statut_lot", "date_vente")
        )
    )
    return result


def measures(normalised: bool = False) -> dict[str, Measure]:
    return {m.name: m for m in [*BASE_MEASURES, *RATIOS, *_filtered(normalised)]}


def model(tables: Mapping[str, DataFrame], normalised: bool = False) -> Model:
    return Model(tables, relationships(), measures(normalised))


QUALITY_CHECKS = tuple(
    Check(table, column, kind)
    for kind, targets in {
        "null_check": (
            ("fact_vente", "vente_id"),
            ("fact_reservation", "reservation_id"),
            ("fact_commission", "commission_id"),
            ("fact_souscription_pierre_papier", "souscription_id"),
            ("dim_investisseur", "investisseur_id"),
            ("dim_conseiller", "conseiller_id"),
            ("dim_programme_immobilier", "programme_id"),
        ),
        "range_check": (
            ("fact_vente", "prix_vente_ttc"),
            ("fact_commission", "montant_commission_brut"),
            ("fact_souscription_pierre_papier", "montant_souscrit"),
        ),
        "duplicate_check": (
            ("fact_vente", "vente_id"),
            ("dim_investisseur", "investisseur_id"),
            ("dim_conseiller", "conseiller_id"),
        ),
    }.items()
    for table, column in targets
)


# Tests on the technical tables: never null, unique, accepted values by column.
TECH_TESTS: dict[str, tuple[tuple[str, ...], tuple[str, ...], dict[str, list[str]]]] = {
    "data_freshness": (("table_schema", "table_name", "checked_at"), (), {}),
    "data_quality_log": (
        ("checked_at", "table_schema", "table_name", "column_name", "check_type", "records_checked", "records_failed", "status"),
        (),
        {"check_type": ["null_check", "range_check", "duplicate_check"], "status": ["pass", "warn", "fail"]},
    ),
    "pipeline_run_log": (("run_id", "environment", "inserted_at"), ("run_id",), {}),
}


def required_columns(spec: DimensionSpec | FactSpec) -> tuple[list[str], list[str]]:
    """Columns of a gold table that must be (never null, unique)."""
    unique = [spec.key, spec.natural_key]
    targets = spec.parents if isinstance(spec, DimensionSpec) else spec.lookups
    never_null = unique + [t.key for t in targets]
    if isinstance(spec, FactSpec):
        never_null += ["statut_key"] if spec.status else []
        never_null += {"fact_vente": ["prix_vente_ttc"], "fact_souscription_pierre_papier": ["montant_souscrit"]}.get(
            spec.name, []
        )
    return never_null, unique
