"""Entity schemas, load order and constraints of the master-data tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {
    "INT": T.IntegerType(), "BIGINT": T.LongType(), "STRING": T.StringType(), "TIMESTAMP": T.TimestampType(),
    "DECIMAL(10,2)": T.DecimalType(10, 2), "DECIMAL(10,8)": T.DecimalType(10, 8),
    "DECIMAL(11,8)": T.DecimalType(11, 8),
}


def _struct(columns: str) -> T.StructType:
    """Schema of ``name TYPE, name TYPE``; needs no session, so it can run at import."""
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Target columns, types and text lengths of the eleven tables; generated ids are BIGINT.
TABLES: dict[str, T.StructType] = {
    "places": _struct("id BIGINT, region STRING, province STRING, city STRING"),
    "services": _struct("id BIGINT, name STRING, description STRING"),
    "equipment": _struct("id BIGINT, name STRING, code STRING, category STRING"),
    "medications": _struct(
        "id BIGINT, name STRING, active_substance STRING, dosage STRING, form STRING, "
        "presentation STRING, therapeutic_class STRING, manufacturer STRING, "
        "price_public DECIMAL(10,2), price_hospital DECIMAL(10,2), commercialization_status STRING"
    ),
    "suppliers": _struct(
        "id BIGINT, name STRING, category STRING, activity STRING, city STRING, "
        "address STRING, phone STRING, responsible_pharmacist STRING"
    ),
    "hospitals": _struct(
        "id BIGINT, name STRING, place_id BIGINT, address STRING, type STRING, beds INT, phone STRING, "
        "email STRING, website STRING, latitude DECIMAL(10,8), longitude DECIMAL(11,8), "
        "source STRING, created_at TIMESTAMP"
    ),
    "hospital_services": _struct("hospital_id BIGINT, service_id BIGINT"),
    "hospital_equipment": _struct("hospital_id BIGINT, equipment_id BIGINT, quantity INT"),
    "hospital_medications": _struct("hospital_id BIGINT, medication_id BIGINT, stock_quantity INT"),
    "supplier_medications": _struct("supplier_id BIGINT, medication_id BIGINT"),
    "supplier_equipment": _struct("supplier_id BIGINT, equipment_id BIGINT"),
}

#: Parents before children; also the order tables are loaded in.
LOAD_ORDER = tuple(TABLES)

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "hospital_services": ("hospital_id", "service_id"),
    "hospital_equipment": ("hospital_id", "equipment_id"),
    "hospital_medications": ("hospital_id", "medication_id"),
    "supplier_medications": ("supplier_id", "medication_id"),
    "supplier_equipment": ("supplier_id", "equipment_id"),
} | {t: ("id",) for t in ("places", "services", "equipment", "medications", "suppliers", "hospitals")}

#: (child, child column, parent, what deleting the parent does)
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("hospitals", "place_id", "places", "set null"),
    ("hospital_services", "hospital_id", "hospitals", "cascade"),
    ("hospital_services", "service_id", "services", "cascade"),
    ("hospital_equipment", "hospital_id", "hospitals", "cascade"),
    ("hospital_equipment", "equipment_id", "equipment", "cascade"),
    ("hospital_medications", "hospital_id", "hospitals", "cascade"),
    ("hospital_medications", "medication_id", "medications", "cascade"),
    ("supplier_medications", "supplier_id", "suppliers", "cascade"),
    ("supplier_medications", "medication_id", "medications", "cascade"),
    ("supplier_equipment", "supplier_id", "suppliers", "cascade"),
    ("supplier_equipment", "equipment_id", "equipment", "cascade"),
)

#: Value a column takes when the extract does not have the column at all.
COLUMN_DEFAULTS: dict[str, dict[str, object]] = {
    "hospitals": {"beds": 0},
    "hospital_equipment": {"quantity": 1},
    "hospital_medications": {"stock_quantity": 0},
}


@dataclass(frozen=True)
class Constraints:
    """Declared rules of one table, checked by ``operators.checks.constraint_violations``."""

    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)


CONSTRAINTS: dict[str, Constraints] = {
    "places": Constraints(("id", "city"), {"region": 100, "province": 100, "city": 100}),
    "hospitals": Constraints(
        ("id", "name"),
        {"name": 255, "type": 100, "phone": 100, "email": 150, "website": 255, "source": 50},
        {"latitude": (10, 8), "longitude": (11, 8)},
    ),
    "suppliers": Constraints(
        ("id", "name"),
        {"name": 255, "category": 100, "city": 100, "phone": 100, "responsible_pharmacist": 150},
    ),
    "medications": Constraints(
        ("id", "name"),
        {"name": 255, "active_substance": 255, "dosage": 100, "form": 100, "presentation": 255,
         "therapeutic_class": 150, "manufacturer": 150, "commercialization_status": 100},
        {"price_public": (10, 2), "price_hospital": (10, 2)},
    ),
    "equipment": Constraints(("id", "name"), {"name": 150, "code": 50, "category": 100}),
    "services": Constraints(("id", "name"), {"name": 150}),
    "hospital_services": Constraints(("hospital_id", "service_id")),
    "hospital_equipment": Constraints(("hospital_id", "equipment_id")),
    "hospital_medications": Constraints(("hospital_id", "medication_id")),
    "supplier_medications": Constraints(("supplier_id", "medication_id")),
    "supplier_equipment": Constraints(("supplier_id", "equipment_id")),
}

# Extract headers and the columns they mean.
HOSPITAL_HEADERS = {
    "Région": "region", "Region": "region",
    "Delegation": "province", "Délégation": "province",
    "Commune": "city",
    "Etablissement hospitalier": "name", "Établissement hospitalier": "name",
    "Catégorie": "type", "Categorie": "type",
}

# Medication extract headers and the columns they mean, in output order.
MEDICATION_HEADERS = {
    "SPECIALITE": "name", "SUBSTANCE ACTIVE": "active_substance", "FORME": "form",
    "PRESENTATION": "presentation", "DOSAGE": "dosage", "EPI": "manufacturer",
    "PPV": "price_public", "PH": "price_hospital",
    "CLASSE THERAPEUTIQUE": "therapeutic_class",
    "STATUT COMMERCIALISATION": "commercialization_status",
}

# Column names that may hold a device's name.
DEVICE_NAME_WORDS = ("nom", "description", "device", "materiel")

# Device names that name nothing.
DEVICE_NOISE = ("Code CNOPS", "Dispositif Médical", "DCM")
