import random

import pytest
from pyspark.sql import functions as F

from recordwell.functions import match, messages, text


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression.alias("o")).first().o


@pytest.mark.parametrize("value, wanted", [
    ("  a \t b\n", "a b"), (" café x ", "café x"), ("NaN", None), (" None ", None),
    ("null", None), ("", None), (None, None), ("annulé", "annulé"), ("a\x1cb", "a b"), ("سيدي  علال", "سيدي علال"),
])
def test_clean_text(spark, value, wanted):
    assert one(spark, text.clean_text("v"), value) == wanted


@pytest.mark.parametrize("value, wanted", [
    ("Fès", "fes"), ("LAÂYOUNE", "laayoune"), ("é", "e"), ("ⵙⵉⴷⵉ", "ⵙⵉⴷⵉ"), (None, None), ("Ñandú ß", "nandu ß"),
])
def test_fold(spark, value, wanted):
    assert one(spark, text.fold("v"), value) == wanted


@pytest.mark.parametrize("value, wanted", [
    ("2 RUE 9 FES", "Fès"), ("87 rue de Rabat", "Rabat"), ("RUE X TANGER", "Tanger"), ("12 FÈS", "Fès"),
    ("Tanger", "Tanger"), ("rue inconnue", "rue inconnue"), (None, None), ("RUE CASABLANCA FES", "Fès"),
])
def test_address_to_city(spark, value, wanted):
    assert one(spark, text.address_to_city("v"), value) == wanted


@pytest.mark.parametrize("value, wanted", [
    ("temara centre", "Témara"), ("Ait Ouqabli آيت", "Ait Ouqabli"), ("Salé", "Salé"), (None, None), ("", ""),
])
def test_canonical_prefix(spark, value, wanted):
    assert one(spark, text.canonical_prefix("v"), value) == wanted


@pytest.mark.parametrize("value, wanted", [
    ("TEMARA", "Temara"), ("ait ouqabli", "Ait ouqabli"), ("élan", "Élan"), ("", ""), ("x", "X"), (None, None),
])
def test_sentence_case(spark, value, wanted):
    assert one(spark, text.sentence_case("v"), value) == wanted


def test_ascii_name_modes(spark):
    assert one(spark, text.ascii_name("v"), "Fès (Mun.)") == "FS MUN"
    assert one(spark, text.ascii_name("v", "fold"), "Fès (Mun.)") == "FES"
    assert one(spark, text.ascii_name("v", "fold"), "Ksar-el-Kébir القصر") == "KSAR EL KEBIR"
    assert one(spark, text.ascii_name("v"), "الرباط") == ""
    with pytest.raises(ValueError):
        text.ascii_name("v", "other")


@pytest.mark.parametrize("value, wanted", [
    ("05.39.94.66.87", "+212539946687"), ("06 61", "+212661"), ("212 5", "+2125"), ("+212 5", "+2125"),
    ("n/a", None), ("", None), (None, None), ("07 11", "0711"),
])
def test_international_phone(spark, value, wanted):
    assert one(spark, text.international_phone("v"), value) == wanted


def test_split_phones(spark):
    got = one(spark, text.split_phones("v"), "05.39.94.66.87 05.39.94.66.88")
    assert got == ["+212539946687", "+212539946688"]


@pytest.mark.parametrize("value, wanted", [
    ("12 bd x 20000 casablanca maroc", "12 BD X CASABLANCA"), ("fes, morocco", "FES"),
    ("banque marocaine", "BANQUEAINE"), (None, None),
])
def test_clean_address(spark, value, wanted):
    assert one(spark, text.clean_address("v"), value) == wanted


def test_clean_address_whole_word(spark):
    assert one(spark, text.clean_address("v", whole_word=True), "banque marocaine, maroc") == "BANQUE MAROCAINE,"


def test_dosage_rules(spark):
    rule = text.decimal_point(text.split_units("v"))
    assert one(spark, rule, "500MG/0,4ml") == "500 MG/0.4 ml"
    assert one(spark, rule, "12 µG") == "12 µG"
    assert one(spark, rule, "0005") == "0005"
    assert one(spark, text.ingredient_separator("v"), "A //B // C") == "A + B + C"


def test_prices(spark):
    assert str(one(spark, text.to_price("v"), "3630,00")) == "3630.00"
    assert one(spark, text.to_price("v"), "NULL") is None
    assert one(spark, text.to_price("v"), "n.c.") is None


@pytest.mark.parametrize("value, wanted", [
    ("a@b.ma", False), ("A@B.MA", False), ("a@b.health", True), ("nobody", True), (None, False), ("a@b", True),
])
def test_email_invalid(spark, value, wanted):
    assert one(spark, text.email_invalid("v"), value) is wanted


def test_email_top_level_length(spark):
    assert one(spark, text.email_invalid("v", max_tld=6), "a@b.health") is False


def test_contact_validation(spark):
    assert one(spark, text.valid_phone("v"), "call") is None
    assert one(spark, text.valid_phone("v"), "+2125") == "+2125"
    assert one(spark, text.valid_website("v"), "www.x.ma") == "https://www.x.ma"
    assert one(spark, text.valid_website("v"), "x.ma") is None
    assert one(spark, text.valid_email("v"), "a@b") is None
    assert one(spark, text.valid_beds("v"), "120") == 120
    assert one(spark, text.valid_beds("v"), "12.5") is None
    assert one(spark, text.valid_beds("v"), "20000") is None
    assert one(spark, text.valid_beds("v"), "many") is None


@pytest.mark.parametrize("value, wanted", [
    ("CHU Ibn Sina", "major"), ("Hôpital RÉGIONAL", "major"), ("Polyclinique", "clinic"), ("Dispensaire", "local"), (None, "local"),
])
def test_facility_tier(spark, value, wanted):
    assert one(spark, text.facility_tier("v"), value) == wanted


@pytest.mark.parametrize("value, wanted", [
    ("Robert", "R163"), ("SHISHAWA", "S000"), ("CHICHAOUA", "C000"), ("", ""), ("Tymczak", "T520"),
    ("IMOUZZER MARMOUCHA", "I5265652"), ("الرباط", ""), ("Pfister", "P236"), ("AA", "A000"), (None, None),
])
def test_soundex_long(spark, value, wanted):
    assert one(spark, match.soundex_long("v"), value) == wanted


def lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a: str, b: str) -> int:
    return round(200 * lcs(a, b) / (len(a) + len(b))) if a or b else 100


def test_similarity_against_plain_definition(spark):
    rng = random.Random(7)
    pairs = [("clinique atlas", "clinic atlas"), ("", ""), ("", "x"), ("a", "a"), ("été 😀", "ete 😀")]
    for _ in range(300):
        a = "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 24)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            at = rng.randint(0, max(len(b) - 1, 0))
            b[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "e"])
        pairs.append((a, "".join(b)))
    long = "".join(rng.choice("abcde") for _ in range(150))
    pairs += [(long, long[:70] + "zz" + long[75:]), (long[:60], long[:61]), (long[:61], long[1:120]), (long[:121], long[3:])]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = {r.i: (r.l, r.s, r.m, r.n) for r in df.select(
        "i", match.lcs_length("a", "b").alias("l"), match.indel_similarity("a", "b").alias("s"),
        match.similar_by_bounds("a", "b", 85).alias("m"), match.lcs_batches()("a", "b").alias("n")).collect()}
    kept = {t: {r.i for r in match.keep_similar(df, "a", "b", t).collect()} for t in (80, 85, 90)}
    for i, (a, b) in enumerate(pairs):
        assert (got[i][0], got[i][1], got[i][3]) == (lcs(a, b), ratio(a, b), lcs(a, b)), (a, b)
        assert got[i][2] in (None, ratio(a, b) > 85), (a, b)
        for t, found in kept.items():
            assert (i in found) == (ratio(a, b) > t), (a, b, t)
    assert sum(g[2] is None for g in got.values()) < len(pairs) / 4


def test_parse_actions_rejects_whole_reply(spark):
    good = '[{"id": 1, "city": "Fès", "action": "UPDATE"}, {"id": 2, "action": "DELETE"}]'
    assert len(one(spark, messages.parse_actions("v"), good)) == 2
    assert one(spark, messages.parse_actions("v"), '[{"id": 1}]') is None
    assert one(spark, messages.parse_actions("v"), '{"id": 1, "action": "DELETE"}') is None
    assert one(spark, messages.parse_actions("v"), "no json") is None
    assert one(spark, messages.parse_actions("v"), "[]") == []
    assert one(spark, messages.parse_actions("v"), None) is None


def test_records_json_writes_nulls(spark):
    df = spark.createDataFrame([(1, None)], "id int, city string")
    got = df.select(messages.records_json(F.array(F.struct("id", "city"))).alias("j")).first().j
    assert got == '[{"id":1,"city":null}]'
