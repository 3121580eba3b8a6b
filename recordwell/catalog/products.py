"""Queries on medication and facility tables: standard forms and rule checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordwell.catalog.registry import HOSPITALS, MEDICATIONS, query, table
from recordwell.functions import text
from recordwell.operators import checks
from recordwell.plans import products as plan

_PRICE = "TRY_CAST(replace(CASE WHEN trim({0}) IN ('NULL', '') THEN NULL ELSE trim({0}) END, ',', '.') AS DECIMAL(10,2))"
_MEDS = (
    f"m AS ({MEDICATIONS.sql}), s AS (SELECT id, upper(trim(name)) AS name, "
    r"regexp_replace(upper(trim(active_substance)), '\s*//\s*', ' + ', 'g') AS active_substance, "
    "upper(trim(form)) AS form, upper(trim(presentation)) AS presentation, "
    r"replace(regexp_replace(dosage, '([0-9])([a-zA-Z])', '\1 \2', 'g'), ',', '.') AS dosage, "
    "upper(trim(therapeutic_class)) AS therapeutic_class, upper(trim(manufacturer)) AS manufacturer, "
    f"{_PRICE.format('price_public')} AS price_public, {_PRICE.format('price_hospital')} AS price_hospital, "
    "trim(commercialization_status) AS commercialization_status FROM m)"
)


def _medications(spark, folder):
    return plan.standardise_medications(MEDICATIONS.frame(spark, folder))


@query("standardise_text", f"WITH {_MEDS} SELECT id, name, active_substance, form, presentation, therapeutic_class, "
       "manufacturer, commercialization_status FROM s")
def _(spark, folder):
    return _medications(spark, folder).select(
        "id", "name", "active_substance", "form", "presentation", "therapeutic_class", "manufacturer",
        "commercialization_status")


@query("split_units", f"WITH {_MEDS} SELECT id, dosage FROM s")
def _(spark, folder):
    return _medications(spark, folder).select("id", "dosage")


@query("parse_prices", f"WITH {_MEDS} SELECT id, CAST(price_public AS DOUBLE) AS price_public, "
       "CAST(price_hospital AS DOUBLE) AS price_hospital FROM s")
def _(spark, folder):
    df = _medications(spark, folder)
    return df.select("id", *[F.col(c).cast("double").alias(c) for c in ("price_public", "price_hospital")])


@query("price_inversion", f"WITH {_MEDS} SELECT id, name FROM s WHERE price_hospital > price_public")
def _(spark, folder):
    return checks.price_inversion(_medications(spark, folder)).select("id", "name")


@query("duplicate_report", f"WITH {_MEDS} SELECT name, dosage, form, count(*) AS duplicate_count FROM s "
       "GROUP BY name, dosage, form HAVING count(*) > 1")
def _(spark, folder):
    return checks.duplicate_report(_medications(spark, folder), ["name", "dosage", "form"])


@query("dosage_mismatch", f"WITH {_MEDS} SELECT name, active_substance, dosage FROM s WHERE contains(active_substance, '+') "
       "AND NOT contains(dosage, '/') AND NOT contains(dosage, '+')")
def _(spark, folder):
    return checks.dosage_mismatch(_medications(spark, folder))


_DIGITS = "regexp_replace({0}, '[^0-9+]', '', 'g')"
_PHONE = (
    "nullif(CASE WHEN left({0}, 2) IN ('05', '06') THEN '+212' || substr({0}, 2) "
    "WHEN left({0}, 3) = '212' THEN '+' || {0} ELSE {0} END, '')"
)


def phone_sql(c: str) -> str:
    return _PHONE.format(_DIGITS.format(c))


_ADDRESS = ("regexp_replace(trim(replace(trim(replace(upper(trim(address)), ' MAROC', '')), ', MOROCCO', '')), '[0-9]{5} ', '', 'g')")
_EMAIL = r"regexp_matches(email, '^[A-Za-z0-9._%-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,4}$')"
_HOSP = (
    f"h AS ({HOSPITALS.sql}), s AS (SELECT id, upper(trim(name)) AS name, place_id, city, {_ADDRESS} AS address, "
    f"upper(trim(type)) AS type, nullif(beds, 0) AS beds, {phone_sql('phone')} AS phone, "
    "CASE WHEN lower(trim(email)) IN ('null', '') THEN NULL ELSE lower(trim(email)) END AS email, "
    "CASE WHEN lower(trim(website)) IN ('null', '') THEN NULL ELSE lower(trim(website)) END AS website FROM h)"
)


def _hospitals(spark, folder):
    return plan.standardise_hospitals(HOSPITALS.frame(spark, folder))


@query("standardise_hospitals", f"WITH {_HOSP} SELECT id, name, place_id, city, address, type, beds, phone, email, website FROM s")
def _(spark, folder):
    return _hospitals(spark, folder)


@query("address_clean", f"WITH {_HOSP} SELECT id, address FROM s")
def _(spark, folder):
    return _hospitals(spark, folder).select("id", "address")


@query("phone_international", "SELECT doc_id, position, " + phone_sql("number") + " AS phone FROM ("
       r"SELECT doc_id, unnest(range(1, len(f) + 1)) AS position, unnest(f) AS number FROM (SELECT doc_id, "
       r"regexp_extract_all(text, '\+?[0-9][0-9 .\-]{6,}[0-9]') AS f FROM documents))")
def _(spark, folder):
    found = F.regexp_extract_all("text", F.lit(r"(\+?[0-9][0-9 .\-]{6,}[0-9])"), F.lit(1))
    return table(spark, folder, "documents").select("doc_id", F.posexplode(found).alias("position", "number")).select(
        "doc_id", (F.col("position") + 1).cast("bigint").alias("position"), text.international_phone("number").alias("phone"))


@query("split_phones", f"WITH h AS ({HOSPITALS.sql}) SELECT id, {phone_sql('number')} AS phone FROM (SELECT id, "
       "unnest(regexp_extract_all(phone, '0[0-9](?:[ .]?[0-9]{2}){4}')) AS number FROM h)")
def _(spark, folder):
    df = HOSPITALS.frame(spark, folder)
    return df.select("id", F.explode(text.split_phones("phone")).alias("phone"))


@query("email_invalid", "SELECT doc_id, email FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^ \\n\\t]*@[^ \\n\\t]*')) AS email FROM documents) "
       f"WHERE NOT {_EMAIL}")
def _(spark, folder):
    found = F.filter(F.split("text", "[ \n\t]"), lambda word: word.contains("@"))
    mails = table(spark, folder, "documents").select("doc_id", F.explode(found).alias("email"))
    return checks.bad_emails(mails, ["doc_id", "email"])


@query("bad_emails", f"WITH {_HOSP} SELECT id, name, email FROM s WHERE email IS NOT NULL AND NOT {_EMAIL}")
def _(spark, folder):
    return checks.bad_emails(_hospitals(spark, folder))


@query("unreachable", f"WITH {_HOSP} SELECT id, name FROM s WHERE phone IS NULL AND email IS NULL")
def _(spark, folder):
    return checks.unreachable(_hospitals(spark, folder)).select("id", "name")


@query("type_frequency", f"WITH {_HOSP} SELECT type, count(*) AS count FROM s GROUP BY type ORDER BY count DESC, type")
def _(spark, folder):
    return checks.frequency(_hospitals(spark, folder), "type")


@query("hospital_duplicates", f"WITH {_HOSP} SELECT name, place_id, count(*) AS duplicate_count FROM s "
       "GROUP BY name, place_id HAVING count(*) > 1")
def _(spark, folder):
    return checks.duplicate_report(_hospitals(spark, folder), ["name", "place_id"])


@query("tier_classify", f"WITH h AS ({HOSPITALS.sql}) SELECT tier, count(*) AS facilities, min(low) AS least_beds, max(high) AS most_beds "
       "FROM (SELECT tier, CASE tier WHEN 'major' THEN 300 WHEN 'clinic' THEN 30 ELSE 10 END AS low, "
       "CASE tier WHEN 'major' THEN 800 WHEN 'clinic' THEN 150 ELSE 60 END AS high FROM (SELECT CASE "
       "WHEN contains(lower(type), 'chu') OR contains(lower(type), 'universitaire') OR contains(lower(type), 'régional') THEN 'major' "
       "WHEN contains(lower(type), 'clinique') OR contains(lower(type), 'polyclinique') THEN 'clinic' ELSE 'local' END AS tier FROM h)) GROUP BY tier")
def _(spark, folder):
    df = HOSPITALS.frame(spark, folder).select(text.facility_tier("type").alias("tier"))
    return df.groupBy("tier").agg(
        F.count("*").alias("facilities"),
        F.min(text.tier_bound("tier", "beds", "low")).alias("least_beds"),
        F.max(text.tier_bound("tier", "beds", "high")).alias("most_beds"))


@query("validate_contact", f"WITH h AS ({HOSPITALS.sql}) SELECT id, "
       "CASE WHEN phone = '' OR starts_with(phone, '+212') OR starts_with(phone, '0') THEN phone END AS phone, "
       "CASE WHEN email = '' OR (contains(email, '@') AND contains(email, '.')) THEN email END AS email, "
       "CASE WHEN website = '' OR starts_with(website, 'http://') OR starts_with(website, 'https://') THEN website "
       "WHEN starts_with(website, 'www.') THEN 'https://' || website END AS website, "
       "CASE WHEN beds * 30 BETWEEN 0 AND 10000 THEN CAST(beds * 30 AS INT) END AS beds FROM h")
def _(spark, folder):
    df = HOSPITALS.frame(spark, folder)
    return df.select(
        "id", text.valid_phone("phone").alias("phone"), text.valid_email("email").alias("email"),
        text.valid_website("website").alias("website"),
        text.valid_beds((F.col("beds") * 30).cast("string")).alias("beds"))
