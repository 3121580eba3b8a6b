"""The four stages on small invented extracts."""

import json

import pytest

from recordwell.plans import stages


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    (folder / "gov_hospitals.csv").write_text(
        "Ministère\nListe 2022\nRégion,Délégation,Commune,Etablissement hospitalier,Catégorie\n"
        "R-Nord,P-Tanger,Tanger,Hôpital Mohammed V,HP\nR-Nord,P-Tanger,Tanger,Hopital  Al Kortobi,HP\n,,,,\n"
        "R-Sud,P-Agadir,Agadir,CHU Souss,CHU Universitaire\nR-Nord,P-Tanger,Larache,,HP\n", encoding="utf-8")
    (folder / "osm_hospitals.csv").write_text(
        "name,city,address,type,latitude,longitude,phone\n"
        "Hôpital Mohamed V,Tanger,rue 1,,35.7,x,0539\nClinique Atlas,Agadir,,Clinique,30.4,-9.6,\n"
        "nan,Agadir,,,1,1,\nClinic Atlas,Agadir,bd 2,Clinique,30.4,-9.6,0528\nClinique Nord,,,Clinique,,,\n", encoding="utf-8")
    (folder / "medicaments.json").write_text(json.dumps([
        {"SPECIALITE": "OCULEX", "SUBSTANCE ACTIVE": "KETOLEX", "DOSAGE": "0005", "EPI": "Sud Labo", "PPV": "36,30", "PH": "22,70", "FORME": "COLLYRE"},
        {"nom": "DOLIX", "EPI": "Nobody"}, 7, {"SPECIALITE": "nan"}, {"SPECIALITE": "OCULEX", "DOSAGE": "2"}, {"SPECIALITE": " MAGNEX ", "EPI": "SUD LABO"},
    ]), encoding="utf-8")
    (folder / "dispositifs.json").write_text(json.dumps([
        {"NOM": "ZED MEDICAL", "ACTIVITE": "Importation", "ADRESSE": "N 22"}, {"NOM": "  "}, "x", {"NOM": "SHARED NAME"}]), encoding="utf-8")
    (folder / "etablissements.json").write_text(json.dumps([
        {"NOM": "SHARED NAME", "VILLE": "RABAT"}, {"NOM": "GROUPE SUD LABO SA", "VILLE": "FES", "TEL": "05.35", "NOM PHARMACIEN RESPONSABLE": "M. X"}]), encoding="utf-8")
    (folder / "medical_devices.csv").write_text(
        "Réf,Description du device,code\n1,Scanner CT,EQ-1\n2,AB123,EQ-2\n3,DCM,\n4,IRM,\n5,Code CNOPS,\n6,Respirateur,EQ-6\n7,Respirateur,EQ-7\n", encoding="utf-8")
    (folder / "equipment_ref.csv").write_text("name,code,category\nScanner CT,REF-1,Imagerie\nIRM,REF-2,\n", encoding="utf-8")
    (folder / "services_ref.csv").write_text("name\nUrgences 24/7\n Cardiologie \nCardiologie\n", encoding="utf-8")
    return str(folder)


@pytest.fixture(scope="module")
def done(spark, raw, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("work"))
    assert set(stages.load(spark, raw, f"{work}/raw")) == {
        "gov_hospitals", "osm_hospitals", "medications", "suppliers", "devices", "equipment_ref", "services_ref"}
    stages.normalise(spark, f"{work}/raw", f"{work}/processed")
    stages.enrich(spark, f"{work}/processed", f"{work}/enriched")
    spark.sql("DROP DATABASE IF EXISTS stage_check CASCADE")
    checks = stages.publish(spark, f"{work}/enriched", "stage_check")
    yield work, checks
    spark.sql("DROP DATABASE IF EXISTS stage_check CASCADE")


def read(spark, done, stage, name):
    return spark.read.parquet(f"{done[0]}/{stage}/{name}")


def test_places_fill_gaps_and_number_densely(spark, done, rows):
    assert rows(read(spark, done, "processed", "places"), "id", "city", "region", "province") == [
        (1, "Tanger", "R-Nord", "P-Tanger"), (2, "Agadir", "R-Sud", "P-Agadir"), (3, "Larache", "R-Nord", "P-Tanger")]


def test_hospitals_are_deduplicated(spark, done, rows):
    got = rows(read(spark, done, "processed", "hospitals"), "id", "name", "city", "region", "type", "source", "place_id")
    # the map row of Mohammed V is the more complete one; both clinics in Agadir differ too much to match
    assert [r[1:] for r in got] == [
        ("Hopital Al Kortobi", "Tanger", "R-Nord", "HP", "gov", 1),
        ("CHU Souss", "Agadir", "R-Sud", "CHU Universitaire", "gov", 2),
        ("Hôpital Mohamed V", "Tanger", "R-Nord", "Hôpital", "osm", 1),
        ("Clinique Atlas", "Agadir", "R-Sud", "Clinique", "osm", 2),
        ("Clinic Atlas", "Agadir", "R-Sud", "Clinique", "osm", 2),
        ("Clinique Nord", None, None, "Clinique", "osm", None),
    ]
    assert [r[0] for r in got] == [1, 2, 3, 4, 5, 6]


def test_medications(spark, done, rows):
    assert rows(read(spark, done, "processed", "medications"), "id", "name", "dosage", "manufacturer", "price_public") == [
        (1, "OCULEX", "0005", "Sud Labo", "36,30"), (2, "DOLIX", None, "Nobody", None), (3, "MAGNEX", None, "SUD LABO", None)]


def test_suppliers_prefer_device_makers(spark, done, rows):
    assert rows(read(spark, done, "processed", "suppliers"), "id", "name", "category", "city") == [
        (1, "ZED MEDICAL", "Dispositif Médical", None), (2, "SHARED NAME", "Dispositif Médical", None),
        (3, "GROUPE SUD LABO SA", "Grossiste Pharmaceutique", "FES")]


def test_supplier_links(spark, done, rows):
    assert rows(read(spark, done, "processed", "supplier_medications"), "supplier_id", "medication_id") == [(3, 1), (3, 3)]


def test_equipment_prefers_the_reference(spark, done, rows):
    assert rows(read(spark, done, "processed", "equipment"), "id", "name", "code", "category") == [
        (1, "Scanner CT", "REF-1", "Imagerie"), (2, "IRM", "REF-2", "Autre équipement"), (3, "Respirateur", "EQ-6", "Dispositif Médical")]


def test_services(spark, done, rows):
    assert rows(read(spark, done, "processed", "services"), "id", "name", "description") == [
        (1, "Urgences 24/7", None), (2, "Cardiologie", None)]


def test_published_tables_pass_their_checks(spark, done, rows):
    _, checks = done
    counts = {r.table_name: (r.rows, r.status) for r in checks["counts"].collect()}
    assert counts["hospitals"] == (6, "ok") and counts["supplier_equipment"] == (0, "warn")
    assert counts["hospital_services"][0] >= 6
    for name, report in checks.items():
        if name != "counts":
            assert report.count() == 0, name
    price = spark.table("stage_check.medications").filter("id = 1").first().price_public
    assert str(price) == "36.30"


def test_values_that_do_not_fit_are_reported(spark):
    given = {"medications": spark.createDataFrame([(1, "A", "123456789012.5"), (2, "B", "n.c."), (3, "C", "5.50")], "id long, name string, price_public string")}
    from recordwell.plans.stages import verify
    from recordwell.sources.writers import conform
    report = verify({"medications": conform(given["medications"], "medications")}, given)["medications: columns"]
    assert sorted(r.id for r in report.collect()) == [1, 2]


def test_enrichment_goes_on_without_dimensions_and_resumes(spark, done, tmp_path, rows):
    calls = tmp_path / "calls"

    def search(prompt):
        with open(calls, "a") as file:
            file.write("search\n")
        return json.dumps({"address": "rue 9", "website": "www.x.ma"})

    def capacity(prompt):
        with open(calls, "a") as file:
            file.write("capacity\n")
        return json.dumps({"hospitals": [{"id": 1, "service_count": 2, "equipment_count": 2, "beds": 77}]})

    read(spark, done, "processed", "hospitals").write.parquet(str(tmp_path / "in/hospitals"))
    options = {"search_model": search, "capacity_model": capacity, "state": str(tmp_path / "state")}
    assert stages.enrich(spark, str(tmp_path / "in"), str(tmp_path / "out"), **options) == ["hospitals"]
    first = rows(spark.read.parquet(str(tmp_path / "out/hospitals")), "id", "address", "website", "beds")
    made = calls.read_text().split()
    assert first[0][1:] == ("rue 9", "https://www.x.ma", 77) and made.count("search") == 6 and made.count("capacity") == 1
    stages.enrich(spark, str(tmp_path / "in"), str(tmp_path / "out"), **options)
    assert calls.read_text().split() == made and rows(spark.read.parquet(str(tmp_path / "out/hospitals")), "id", "address", "website", "beds") == first
    # without models what was found before is used
    stages.enrich(spark, str(tmp_path / "in"), str(tmp_path / "out"), state=str(tmp_path / "state"))
    assert rows(spark.read.parquet(str(tmp_path / "out/hospitals")), "id", "address", "website", "beds") == first
    assert stages.enrich(spark, str(tmp_path / "nowhere"), str(tmp_path / "out")) == []


def test_all_tables_are_published_as_one_version(spark, done, tmp_path):
    checks = stages.publish_snapshot(spark, f"{done[0]}/enriched", str(tmp_path / "versions"))
    counts = {r.table_name: r.rows for r in checks["counts"].collect()}
    assert len(counts) == 11 and counts["hospitals"] == 6 and counts["supplier_equipment"] == 0
