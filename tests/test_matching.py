import random
import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from recordwell.catalog import QUERIES
from recordwell.operators.contain import containment_pairs, drop_containers, link_by_containment
from recordwell.operators import edits as edits_module
from recordwell.operators.edits import edit_distance_pairs, typo_match
from recordwell.operators.fill import (
    apply_actions, fill_missing, gap_fill, lookup_key, self_fill, split_by_cache,
)
from recordwell.operators.similar import eliminate, fuzzy_dedup, similar_pairs
from recordwell.plans.places import CITY_DICTIONARY, clean_places, promote_places, repair_places
from tests.plans import assert_scalable
from tests.test_text import ratio


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def words(rng, n, low, high, letters="abcd"):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)})


def mutate(rng, word, letters="abcd"):
    out = list(word)
    for _ in range(rng.randint(0, 3)):
        at = rng.randint(0, len(out))
        out[at:at + rng.randint(0, 1)] = rng.choice(["", *letters])
    return "".join(out)


@pytest.mark.parametrize("k", [1, 2])
def test_edit_join_finds_every_pair(spark, k):
    rng = random.Random(k)
    good = words(rng, 150, 1, 9) + words(rng, 60, 26, 38)
    bad = sorted({mutate(rng, w) for w in good for _ in range(3)} | set(words(rng, 80, 0, 4)))
    wanted = {(a, b, edits(a, b)) for a in bad for b in good if a and b and 1 <= edits(a, b) <= k}
    left = spark.createDataFrame([(w,) for w in bad], "a string")
    right = spark.createDataFrame([(w,) for w in good], "b string")
    joined = edit_distance_pairs(left, right, "a", "b", k)
    assert_scalable(joined)
    assert {tuple(r) for r in joined.select("a", "b", "distance").distinct().collect()} == wanted
    assert any(len(a) > 32 for a, _, _ in wanted) and any(len(a) < 3 for a, _, _ in wanted)


@pytest.mark.parametrize("held", [10**6, 50])
def test_nearest_is_the_best_of_all_pairs(spark, monkeypatch, held):
    monkeypatch.setattr(edits_module, "VARIANTS_HELD", held)
    monkeypatch.setattr(edits_module, "PAIRS_HELD", held)
    rng = random.Random(held)
    good = words(rng, 200, 1, 9) + words(rng, 60, 26, 38) + ["é" * 30, "京都", "京"]
    bad = sorted({mutate(rng, w) for w in good for _ in range(2)} | set(good[::3]) | set(words(rng, 80, 0, 4)) | {"é" * 31, "東京"})
    value = {w: rng.choice([-3, -2, -1, None]) for w in good}
    order = {w: float("inf") if v is None else v for w, v in value.items()}
    wanted = {}
    for a in bad:
        near = [(d, order[b], b) for b in good if a and a != b and abs(len(a) - len(b)) <= 2 and (d := edits(a, b)) <= 2]
        if near:
            wanted[a] = (min(near)[2], min(near)[0])
    left = spark.createDataFrame([(w,) for w in bad], "a string")
    right = spark.createDataFrame(list(value.items()), "b string, v long")
    got = edit_distance_pairs(left, right, "a", "b", 2, nearest="v").collect()
    assert len(got) == len(wanted) and {r["a"]: (r["b"], r["distance"]) for r in got} == wanted


def test_tasks_without_names_find_nothing(spark):
    none = pd.DataFrame({"name": [], "left": [], "right": [], "rank": [], "cut": []})
    assert not [*edits_module._nearest_in_task(iter([]), 2), *edits_module._nearest_in_task(iter([none]), 2)]
    one = spark.createDataFrame([("ab",)], "a string")
    other = spark.createDataFrame([("abc", 1)], "b string, v long")
    assert edit_distance_pairs(one, other, "a", "b", 2, nearest="v").collect() == [("ab", "abc", 1, 1)]


def test_many_keys_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(edits_module, "BROADCAST_KEYS", 10)
    left = spark.createDataFrame([("abcdefgh",), ("bcdefghi",)], "a string")
    plan = edit_distance_pairs(left, left.withColumnRenamed("a", "b"), "a", "b", 2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


#: Words of several scripts, of one letter and of many, used once and often.
SCRIPTS = [
    "Élève élèves eleve a à b 東京 東京都 京 Москва москвы москва naïve naive naïveté", "straße strasse STRASSE, x-ray हिन्दी हिन्दि؛ مدينة مدينه",
    "cafe\u0301 café cafés " + "ab" * 40 + " " + "ab" * 39 + "ba " + "é" * 70 + " " + "é" * 71, "élève naive naive b", None, "", "1234 !?",
]


def distinct_words(texts):
    uses = {}
    for text in texts:
        run = ""
        for c in (text or "").lower() + " ":
            if unicodedata.category(c)[0] in "LM":
                run += c
            elif run:
                uses[run], run = uses.get(run, 0) + 1, ""
    return uses


def test_edits_cover_all_words_of_any_script(spark, tmp_path, rows):
    spark.createDataFrame([(t,) for t in SCRIPTS], "text string").write.parquet(f"{tmp_path}/documents.parquet")
    uses, wanted = distinct_words(SCRIPTS), []
    for a in uses:
        near = [(edits(a, b), -uses[b], b) for b in uses if a != b and edits(a, b) <= 2]
        wanted += [(a, min(near)[2], min(near)[0])] if near else []
    got = rows(QUERIES["edit_distance_all_words"](spark, str(tmp_path)), "word", "known", "distance")
    assert got == sorted(wanted, key=repr)
    assert {"élève", "東京", "b", "é" * 70} <= {a for a, _, _ in got}


def test_containment_covers_all_words_of_any_script(spark, tmp_path, rows):
    hosts = ["élève.example", "a.b", "東京都.jp", "москва.рф", "www.naive.org", ""]
    spark.createDataFrame([(f"https://{h}/x",) for h in hosts] + [(None,)], "url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(t,) for t in SCRIPTS], "text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = rows(QUERIES["containment_all_words"](spark, str(tmp_path)), "host", "word")
    assert got == sorted(((h, w) for h in hosts for w in distinct_words(SCRIPTS) if w in h), key=repr)
    assert {("a.b", "b"), ("東京都.jp", "京"), ("élève.example", "élève"), ("москва.рф", "москва")} <= set(got)


def test_typo_match_prefers_distance_then_id(spark, rows):
    df = spark.createDataFrame([
        (1, "RABAT", "r1", "p1"), (2, "RABAS", "r2", "p2"), (3, "RABATS", None, None), (4, "RABBATTT", None, None),
        (5, "X", None, None), (6, None, None, None), (7, "RABAT", "r7", "p7"),
    ], "id int, city string, region string, province string")
    got = typo_match(df, "city", ["region", "province"], min_length=3)
    assert rows(got) == sorted([
        (1, "RABAT", "r1", "p1"), (2, "RABAS", "r2", "p2"), (3, "RABAT", "r1", "p1"), (4, "RABBATTT", None, None),
        (5, "X", None, None), (6, None, None, None), (7, "RABAT", "r7", "p7")], key=repr)


def test_containment_join_finds_every_pair(spark):
    rng = random.Random(3)
    hay = words(rng, 200, 0, 20, "ab ")
    needles = words(rng, 60, 0, 6, "ab ")
    left = spark.createDataFrame([(w,) for w in hay], "h string")
    right = spark.createDataFrame([(w,) for w in needles], "n string")
    joined = containment_pairs(left, "h", right, "n")
    assert_scalable(joined)
    got = [tuple(r) for r in joined.collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(h, n) for h in hay for n in needles if n and n in h}


def test_drop_containers(spark, rows):
    df = spark.createDataFrame([
        (1, "FES", "r"), (2, "AIN SEBAA FES", None), (3, "FES", None), (4, "AGADIR FES", "r"), (5, "SALE", None),
        (6, None, None), (7, "", "r"),
    ], "id int, city string, region string")
    assert [r[0] for r in rows(drop_containers(df, "city", "region"))] == [1, 3, 4, 5, 6, 7]


def test_link_by_containment(spark, rows):
    meds = spark.createDataFrame([(1, "Sud Labo"), (2, "SUD LABO"), (3, "none"), (4, None), (5, "LAB")], "m int, maker string")
    sellers = spark.createDataFrame([(7, "SUD-LABO"), (8, "the sud labo sarl"), (9, "SUD LABORA"), (2, "lab x"), (3, "LABO")], "s int, name string")
    assert rows(link_by_containment(meds, "maker", "m", sellers, "name", "s", "s")) == [(2, 5), (8, 1), (8, 2)]
    from recordwell.functions.text import spaceless
    loose = link_by_containment(meds, "maker", "m", sellers, "name", "s", "s", key=lambda c: spaceless(F.lower(c)))
    assert rows(loose) == [(2, 5), (7, 1), (7, 2)]


def facility_names(rng, n):
    base = ["clinique atlas", "clinic atlas", "centre de sante ain", "centre de sante aine", "hopital ibn sina",
            "hôpital ibn sina", "dispensaire rural", "cm", "c", "polyclinique du sud", "clinique du sud"]
    return [mutate(rng, rng.choice(base), "aeins") for _ in range(n)]


@pytest.mark.parametrize("threshold, tile", [(80, 2000), (85, 2000), (92, 2000), (85, 3), (85, 25)])
def test_similar_pairs_finds_every_pair(spark, threshold, tile):
    rng = random.Random(threshold)
    data = sorted({(rng.choice(["x", "y", None]), n) for n in facility_names(rng, 400)}, key=repr)
    df = spark.createDataFrame(data, "city string, name string")
    joined = similar_pairs(df, "name", ["city"], threshold, tile=tile)
    assert_scalable(joined)
    got = [(r.block.city, r.a.name, r.b.name) for r in joined.collect()]
    wanted = {
        (c, a, b) for c, a in data for d, b in data
        if c == d and a < b and ratio(a, b) > threshold and (a and b)
    }
    assert len(got) == len(set(got)) and set(got) == wanted and len(wanted) > 100


def test_similar_pairs_refuses_thresholds_it_cannot_serve(spark):
    with pytest.raises(ValueError):
        similar_pairs(spark.createDataFrame([("a", "b")], "city string, name string"), "name", ["city"], 70)


def sweep(duels):
    """Duels one by one in time order."""
    gone = set()
    for t, w, l in sorted(duels):
        if w not in gone and l not in gone:
            gone.add(l)
    return gone


@pytest.mark.parametrize("group_edges", [0, 40, 10_000])
def test_eliminate_equals_playing_in_order(spark, group_edges):
    rng = random.Random(11)
    for n in (5, 30, 80):
        strength = list(range(n))
        rng.shuffle(strength)
        pairs = {(min(a, b), max(a, b)) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(4 * n)) if a != b}
        order = list(pairs)
        rng.shuffle(order)
        duels = [(t, *((a, b) if strength[a] > strength[b] else (b, a))) for t, (a, b) in enumerate(order)]
        df = spark.createDataFrame(duels, "t int, w int, l int").withColumn("g", F.lit(1))
        got = [r.l for r in eliminate(df, group_edges).collect()]
        assert sorted(got) == sorted(sweep(duels))


def greedy(rows_, threshold=85):
    """The sequential rule, row by row: rows are (id, name, city, source, filled)."""
    visit = sorted(rows_, key=lambda r: (0 if r[3] == "osm" else 1, r[0]))
    gone = set()
    for one in visit:
        if one[0] in gone:
            continue
        for two in visit:
            if two[0] <= one[0] or two[0] in gone:
                continue
            if one[2] == two[2] and one[1] and two[1] and ratio(one[1].lower(), two[1].lower()) > threshold:
                if one[4] >= two[4]:
                    gone.add(two[0])
                else:
                    gone.add(one[0])
                    break
    return [r[0] for r in rows_ if r[0] not in gone]


@pytest.mark.parametrize("seed", range(4))
def test_fuzzy_dedup_equals_the_sequential_rule_on_distinct_names(spark, seed):
    rng = random.Random(seed)
    taken, data = set(), []
    for i, name in enumerate(facility_names(rng, 160)):
        city = rng.choice(["x", "x", "y", None])
        if (name.lower(), city) in taken:
            continue
        taken.add((name.lower(), city))
        data.append((i, name if rng.random() < 0.95 else None, city, rng.choice(["gov", "osm"]),
                     rng.choice([None, "1"]), rng.choice([None, "2"])))
    df = spark.createDataFrame(data, "id int, name string, city string, source string, phone string, email string")
    visit = [F.when(F.col("source") == "osm", 0).otherwise(1)]
    got = fuzzy_dedup(df, "name", ["city"], "id", visit)
    wanted = greedy([(r[0], r[1], r[2], r[3], sum(v is not None for v in r)) for r in data])
    assert sorted(r.id for r in got.collect()) == sorted(wanted)


def test_fuzzy_dedup_reduces_copies_to_the_best(spark):
    data = [(i, "Clinique Atlas" if i % 2 else "CLINIQUE ATLAS", "x", "1" if i == 40 else None) for i in range(200)]
    data += [(300, "clinic atlas", "x", "1"), (301, "clinique atlass", "x", "1"), (302, "clinique atlas", "y", None)]
    df = spark.createDataFrame(data, "id int, name string, city string, phone string")
    assert sorted(r.id for r in fuzzy_dedup(df, "name", ["city"], "id").collect()) == [40, 300, 302]
    exact = fuzzy_dedup(df, "name", ["city"], "id", threshold=None)
    assert sorted(r.id for r in exact.collect()) == [40, 300, 301, 302]


def test_gap_fill_and_lookup(spark, rows):
    df = spark.createDataFrame([
        (1, "a", None, None), (2, "a", "r2", None), (3, "a", "r3", "p3"), (4, None, None, None), (5, "b", None, "p5"), (6, "a", None, "p6"),
    ], "id int, city string, region string, province string")
    assert rows(gap_fill(df, "city", ["region", "province"], "id")) == sorted([
        (1, "a", "r2", None), (2, "a", "r2", None), (3, "a", "r3", "p3"), (4, None, None, None), (5, "b", None, "p5"), (6, "a", "r2", "p6")], key=repr)
    places = spark.createDataFrame([(9, "a")], "id int, city string")
    assert rows(lookup_key(df, places, "city"), "id", "place_id")[:4] == [(1, 9), (2, 9), (3, 9), (4, None)]


def test_self_fill_folds_and_takes_both(spark, rows):
    df = spark.createDataFrame([
        (1, "FÈS", "r", "p"), (2, "Fes", None, "q"), (3, "fès", "s", "t"), (4, "x", None, None)], "id int, city string, region string, province string")
    assert rows(self_fill(df, "city", ["region", "province"])) == [
        (1, "FÈS", "r", "p"), (2, "Fes", "r", "p"), (3, "fès", "s", "t"), (4, "x", None, None)]


def test_fill_missing(spark, rows):
    df = spark.createDataFrame([(1, None, 0), (2, "", None), (3, "05", 7), (4, None, None)], "id int, phone string, beds int")
    found = spark.createDataFrame([(1, "06", 9), (2, "", 0), (3, "07", 8)], "id int, phone string, beds int")
    assert rows(fill_missing(df, found, "id", ["phone", "beds"])) == [(1, "06", 9), (2, "", None), (3, "05", 7), (4, None, None)]


def test_apply_actions(spark, rows):
    df = spark.createDataFrame([(i, "c", None, None) for i in range(1, 7)], "id int, city string, region string, province string")
    acts = spark.createDataFrame([
        (1, 0, "C", "R", None, "UPDATE"), (2, 0, None, None, None, "DELETE"), (3, 0, "X", "Y", "Z", "KEEP"),
        (4, 0, "A", "A", "A", "UPDATE"), (4, 1, "B", None, "B", "UPDATE"), (5, 0, "A", "A", "A", "UPDATE"), (5, 1, None, None, None, "DELETE"),
        (99, 0, "Q", "Q", "Q", "UPDATE"),
    ], "id int, position int, city string, region string, province string, action string")
    assert rows(apply_actions(df, acts, order_by="position")) == sorted([
        (1, "C", "R", None), (3, "c", None, None), (4, "B", None, "B"), (6, "c", None, None)], key=repr)


def test_split_by_cache(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    cache = spark.createDataFrame([(2, 50)], "id int, beds int")
    hits, misses = split_by_cache(df, cache, "id", ["beds"])
    assert rows(hits) == [(2, 50)] and rows(misses) == [(1,)]


PLACES = [
    (1, "Casablanca-Settat", "Casablanca", "Casablanca (Mun.)"), (2, None, None, "casablanka"), (3, None, None, "Ksarelkebir"),
    (4, None, None, "87 RUE IBN"), (5, None, None, "rue x"), (6, None, None, "ain sebaa casablanca"), (7, None, None, "Rabat الرباط"),
    (8, "Fès-Meknès", "Fès", "Fès"), (9, None, None, "fes"), (10, None, None, "Ifrane"), (11, None, None, "ifrane"),
    (12, "NULL", "NULL", "Tiznit"), (13, None, None, "سلا"), (14, "Oriental", "Nador", "Nador"), (15, None, None, "Nadorr"),
]


def test_repair_places(spark):
    df = spark.createDataFrame(PLACES, "id int, region string, province string, city string")
    got = {r.id: (r.city, r.region) for r in repair_places(df).collect()}
    assert got == {
        1: ("CASABLANCA", "Casablanca-Settat"), 3: ("KSAR EL KEBIR", "Tanger-Tétouan-Al Hoceïma"),
        7: ("RABAT", "Rabat-Salé-Kénitra"), 8: ("FES", "Fès-Meknès"), 10: ("IFRANE", None), 12: ("TIZNIT", None),
        13: ("", None), 14: ("NADOR", "Oriental"),
    }


def test_repair_places_plain_mode_drops_accented_letters(spark):
    df = spark.createDataFrame([(1, "r", "p", "Fès"), (2, "r", "p", "Rabat (Mun.)")], "id int, region string, province string, city string")
    got = sorted(r.city for r in repair_places(df, mode="ascii", min_typo_length=1).collect())
    assert got == ["FS", "RABAT MUN"]


def test_repair_plan_has_no_nested_loop(spark):
    df = spark.createDataFrame(PLACES, "id int, region string, province string, city string")
    assert_scalable(repair_places(df))


def test_clean_places_in_rule_order(spark, rows):
    df = spark.createDataFrame([
        (1, "r1", "p1", "Témara (Mun.)", "PENDING"), (2, None, None, "TEMARA", "PENDING"), (3, None, None, "Ait Ouqabli آيت", "PENDING"),
        (4, None, None, "2 RUE 9 FES", "PENDING"), (5, "r5", "p5", "FES", "PENDING"), (6, None, None, "AGADIR (Mun.)", "VALID"),
        (7, None, None, None, "PENDING"), (8, None, None, "temara x", "VALID"),
    ], "raw_id int, region string, province string, city string, validation_status string")
    got = {r.raw_id: tuple(r)[1:] for r in clean_places(df).collect()}
    assert got[2] == ("r1", "p1", "Témara", "VALID")
    assert got[3] == (None, None, "Ait ouqabli", "VALID")
    assert got[4] == ("r5", "p5", "Fès", "VALID")
    assert got[6] == (None, None, "AGADIR (Mun.)", "VALID")
    assert got[7] == (None, None, None, "PENDING")
    assert got[8] == (None, None, "Témara", "VALID")
    last = {r.raw_id: r.city for r in clean_places(df, canonical_last=True).collect()}
    assert last[3] == "Ait Ouqabli"
    promoted = rows(promote_places(clean_places(df)), "city", "region")
    assert promoted == [("AGADIR (Mun.)", "Region Inconnue"), ("Ait ouqabli", "Region Inconnue"), ("Fès", "r5"), ("Témara", "r1")]


def test_dictionary_has_24_cities():
    assert len(CITY_DICTIONARY) == 24 and len({c for c, _, _ in CITY_DICTIONARY}) == 24
