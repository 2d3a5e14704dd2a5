"""Tables, keys, references and rules of the order store (fixed values)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
TEXT = T.StringType()
WHEN = T.TimestampNTZType()
PRICE = T.DecimalType(12, 4)
# A discount is a rate or an amount, as the query takes it.
RATE = T.DecimalType(10, 4)
SMALL = T.DecimalType(4, 0)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# Column names, order and types of the seven tables.
SCHEMAS: dict[str, T.StructType] = {
    "fournisseurs": _struct(
        id_fournisseur=LONG,
        societe_fournisseur=TEXT,
        contact_fournisseur=TEXT,
        fonction_fournisseur=TEXT,
        adresse_fournisseur=TEXT,
        ville_fournisseur=TEXT,
        region_fournisseur=TEXT,
        code_postal_fournisseur=TEXT,
        pays_fournisseur=TEXT,
        tel_fournisseur=TEXT,
        fax_fournisseur=TEXT,
    ),
    "categories": _struct(id_categorie=LONG, nom_categorie=TEXT, description=TEXT),
    "employes": _struct(
        id_employe=LONG,
        nom=TEXT,
        prenom=TEXT,
        fonction_employe=TEXT,
        titre_courtoisie=TEXT,
        date_naissance=WHEN,
        date_embauche=WHEN,
        adresse_employe=TEXT,
        ville_employe=TEXT,
        pays_employe=TEXT,
        tel_domicile=TEXT,
    ),
    "clients": _struct(
        id_client=LONG,
        code_client=TEXT,
        societe=TEXT,
        contact=TEXT,
        fonction=TEXT,
        adresse=TEXT,
        ville=TEXT,
        date_naissance=WHEN,
        region=TEXT,
        code_postal=TEXT,
        pays=TEXT,
        telephone=TEXT,
        fax=TEXT,
    ),
    "produits": _struct(
        id_produit=LONG,
        designation=TEXT,
        id_fournisseur=LONG,
        id_categorie=LONG,
        prix_unitaire=PRICE,
        unites_en_stock=LONG,
        unites_commandees=LONG,
        niveau_reapprovisionnement=LONG,
        indisponible=INT,
    ),
    "commandes": _struct(
        id_commande=LONG,
        id_employe=LONG,
        id_client=LONG,
        date_commande=WHEN,
        date_livraison=WHEN,
        id_transporteur=SMALL,
        frais_port=SMALL,
    ),
    "lignes_commandes": _struct(
        id_ligne_commande=LONG,
        id_commande=LONG,
        id_produit=LONG,
        quantite=LONG,
        remise=RATE,
    ),
}

KEYS: dict[str, str] = {
    "fournisseurs": "id_fournisseur",
    "categories": "id_categorie",
    "employes": "id_employe",
    "clients": "id_client",
    "produits": "id_produit",
    "commandes": "id_commande",
    "lignes_commandes": "id_ligne_commande",
}

# (child table, column, parent table); the parent column is the parent's key.
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    ("produits", "id_fournisseur", "fournisseurs"),
    ("produits", "id_categorie", "categories"),
    ("commandes", "id_employe", "employes"),
    ("commandes", "id_client", "clients"),
    ("lignes_commandes", "id_commande", "commandes"),
    ("lignes_commandes", "id_produit", "produits"),
]

# The line table of a site under the by-query rule also names its client.
SITE_LINE_CLIENT: tuple[str, str, str] = ("lignes_commandes", "id_client", "clients")



def references_of(tables: Mapping) -> list[tuple[str, str, str]]:
    """The references among these tables; lines that name their client refer to it too."""
    own = [*FOREIGN_KEYS, *([SITE_LINE_CLIENT] if "id_client" in tables["lignes_commandes"].columns else [])]
    return [(child, column, parent) for child, column, parent in own if child in tables and parent in tables]


NOT_NULL: dict[str, list[str]] = {"clients": ["societe", "contact", "fonction"]}

# Longest text allowed per column; columns not listed hold 100 characters.
DEFAULT_LENGTH = 100
LENGTHS: dict[tuple[str, str], int | None] = {
    ("clients", "code_postal"): 10,
    ("categories", "description"): None,
}

# Row image of a change to the line table.
CHANGES: T.StructType = _struct(
    seq=LONG,
    op=TEXT,
    id_ligne_commande=LONG,
    id_commande=LONG,
    old_id_produit=LONG,
    old_quantite=LONG,
    old_remise=RATE,
    new_id_produit=LONG,
    new_quantite=LONG,
    new_remise=RATE,
)

# Error codes and texts (fixed values).
BAD_INPUT = -20001
DUPLICATE_LINE = -20002
NO_ORDER = -20003
NO_PRODUCT = -20004
NO_LINE_TO_DELETE = -20005
NO_LINE_TO_UPDATE = -20006
NO_NEW_PRODUCT = -20007
BAD_VALUES = -20008
NO_DATA_FOUND = -1403
UNIQUE_VIOLATED = -1
PARENT_NOT_FOUND = -2291

# Text before and after the id a message names; the id is left out where the text has none.
STRICT_MESSAGES: dict[int, tuple[str, str | None, str]] = {
    BAD_INPUT: ("FAILED: One or more numeric inputs are invalid (<= 0).", None, ""),
    DUPLICATE_LINE: ("FAILED: ID_LIGNE_COMMANDE already exists.", None, ""),
    NO_ORDER: ("FAILED: The requested ID_COMMANDE does not exist.", None, ""),
    NO_PRODUCT: ("FAILED: The requested ID_PRODUIT does not exist.", None, ""),
    NO_LINE_TO_DELETE: ("ERROR: That Ligne Commande ID does not exist.", None, ""),
    NO_LINE_TO_UPDATE: ("FAILED: Ligne Commande ID ", "id_ligne_commande", " not found."),
    NO_NEW_PRODUCT: ("FAILED: Product ID ", "id_produit", " does not exist in the database."),
    BAD_VALUES: ("FAILED: Quantity must be > 0 and Remise must be >= 0.", None, ""),
    UNIQUE_VIOLATED: ("ORA-00001: unique constraint violated", None, ""),
    PARENT_NOT_FOUND: ("ORA-02291: integrity constraint violated - parent key not found", None, ""),
}
HYDRATE_MESSAGES: dict[int, tuple[str, str | None, str]] = {
    BAD_INPUT: ("FAILED: One or more numeric inputs are invalid.", None, ""),
    DUPLICATE_LINE: ("FAILED: ID_LIGNE_COMMANDE already exists.", None, ""),
    NO_LINE_TO_UPDATE: ("FAILED: Ligne Commande ID not found.", None, ""),
    BAD_VALUES: ("FAILED: Quantity must be > 0 and Remise must be >= 0.", None, ""),
    NO_DATA_FOUND: ("ORA-01403: no data found", None, ""),
    UNIQUE_VIOLATED: ("ORA-00001: unique constraint violated", None, ""),
    PARENT_NOT_FOUND: ("ORA-02291: integrity constraint violated - parent key not found", None, ""),
}
