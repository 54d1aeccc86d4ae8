import unicodedata

import pytest
from pyspark.sql import functions as F

from kinfold.functions import organisations as org
from kinfold.functions import people as ppl
from kinfold.functions import places, strings


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("f", "name", "want"),
    [
        (ppl.first_name, "Jean-Francois", "jean"),
        (ppl.initials, "Jean-Francois", "j-f"),
        (ppl.initials, "-x", None),
        (ppl.middle_name, "Jean-Francois", "francois"),
        (ppl.middle_initial, "Jean-Francois", "f"),
        (ppl.first_name, "J. Robert", None),
        (ppl.middle_name, "J. Robert", "robert"),
        (ppl.last_name, "Smith, Jr.", "smith"),
        (ppl.suffixes, "Smith, Jr.", ["jr."]),
        (ppl.normalized, 'Jo"sé', "jose"),
        (ppl.normalized, "Łukasz Ǻ ｶ", "ukasz a "),
        (ppl.last_name, "", None),
        (ppl.first_name, None, None),
        (org.expanded, "Acme Corp., Inc", "Acme corporation incorporated"),
        (org.split_name, "X acting by and through Y", "X "),
        (org.split_name, "A on behalf of B", " B"),
        (org.clean, 'A (x) "B" & C-D', "A B and C D"),
        (strings.clean_text, '"A/b.-c\'"', "a / b  . - c ' "),
    ],
)
def test_one_argument(spark, f, name, want):
    got = one(spark, f(F.col("v")), v=name)
    assert got == want


def test_normalized_equals_decomposition(spark):
    text = "".join(chr(c) for c in range(0x20, 0x2100) if c != 0x22 and not 0xD800 <= c < 0xE000)
    want = unicodedata.normalize("NFD", text).encode("ascii", "ignore").decode().lower()
    assert one(spark, ppl.normalized(F.col("v")), v=text) == want


def test_person_keys(spark):
    key = ppl.person_key(F.col("f"), F.col("l"), F.col("u"))
    assert one(spark, key, f="Mahesh", l="Ramaseshan", u="u1") == "fl:ma_ln:ramaseshan"
    assert one(spark, key, f="Jo", l="Van Der-Berg", u="u1") == "fl:jo_ln:vanderberg"
    assert one(spark, key, f="", l="Lee", u="u1") == "fl:u1_ln:lee"
    assert one(spark, key, f=None, l=None, u="u1") == "fl:u1_ln:u1"


def test_ids(spark):
    ids = ppl.mention_id(F.col("p"), F.col("d"), F.col("s"))
    assert one(spark, ids, p="8022252", d=None, s="5") == "8022252-5"
    assert one(spark, ids, p=None, d="20050192871", s="1") == "pg-20050192871-1"
    assert one(spark, ppl.record_id(F.col("p"), F.col("d")), p="", d="7") == "pg-7"


def test_organisation_key(spark):
    key, blocks = org.key_and_canopies(F.col("n"), F.col("u"))
    row = spark.createDataFrame([("Universal Music Group, Inc.", "u")], "n string, u string").select(key.alias("k"), blocks.alias("b")).first()
    assert row["k"] == "universalmusic"
    assert row["b"] == ["univ", "musi"]


def test_grams(spark):
    got = one(spark, org.word_grams(F.col("v")), v="ab")
    assert got == [" a", "ab", "b ", " ab", "ab ", " ab "]


def test_correction(spark):
    words = spark.createDataFrame([(1, "america"), (2, "american")], "position int, word string")
    rows = spark.createDataFrame([("americas",), ("american",), ("other",)], "t string")
    got = {r["t"]: r["corrected"] for r in org.corrected(rows, "t", words).collect()}
    assert got == {"americas": "america", "american": "america", "other": "other"}


def test_jaro():
    assert strings.jaro("martha", "marhta") == pytest.approx(0.944444, abs=1e-6)
    assert strings.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert strings.jaro("", "") == 1.0


def test_places(spark):
    # derived by hand from the rule tables
    cases = {
        ("ft worth", "tx", "us"): ("fort worth", "tx", "us"),
        ("", "toronto", "ca"): ("toronto", "ontario", "ca"),
        ("lexinton", "ky", "us"): ("lexington", "ky", "us"),
        ("berlin dex", "", ""): ("berlin", "", "de"),
        ("n. bethesda twp", "md", "us"): ("north bethesda township", "md", "us"),
        ("alexandria", "", "va"): ("alexandria", "va", "us"),
        ("saint-denis", "", "fr"): ("saint denis", "", "fr"),
        ("paris 75", "12", "fr"): ("paris ", "", "fr"),
        ("", "", ""): ("", "", ""),
    }
    table = spark.createDataFrame([(*k, *v) for k, v in cases.items()], "a string, b string, c string, x string, y string, z string")
    got = table.select("x", "y", "z", places.remapped(*(F.col(c) for c in "abc")).alias("p")).collect()
    assert [tuple(r["p"]) for r in got] == [tuple(r)[:3] for r in got]
    rows = spark.createDataFrame([(1, "Paris, TX, US"), (2, None), (3, "unknown")], "id int, raw string")
    got = {r["id"]: (r["city"], r["region"], r["country"]) for r in places.reparsed(rows, "raw", ["us"], ["tx"]).collect()}
    assert got == {1: ("paris", "tx", "us"), 2: ("", "", ""), 3: ("", "", "")}
