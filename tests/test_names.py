import unicodedata

import pytest

from namesieve.functions.names import LEGAL_FORMS, normalize_whitespace, strip_accents
from namesieve.operators.naming import name_variants, normalize_names

ENTITY = "entity_id int, entity_name string, entity_type string, country_code string"


def one(spark, expression, text):
    return spark.createDataFrame([(text,)], "t string").selectExpr(f"{expression('t')} AS x").first()["x"]


def normalized(spark, name, kind):
    return normalize_names(spark.createDataFrame([(1, name, kind, "MX")], ENTITY)).first()


def variants(spark, name, kind):
    rows = name_variants(normalize_names(spark.createDataFrame([(1, name, kind, "MX")], ENTITY))).collect()
    return {r["name_variant"]: r["variant_rule"] for r in rows}


@pytest.mark.parametrize(
    "text, expected",
    [("México", "Mexico"), ("Logística", "Logistica"), ("áéíóúÁÉÍÓÚñÑ", "aeiouAEIOUnN"), ("straße Ø ł", "straße Ø ł")],
)
def test_accents(spark, text, expected):
    assert one(spark, strip_accents, text) == expected


def test_accents_follow_the_unicode_database(spark):
    codes = [c for c in range(0x20, 0x30000, 7) if not 0xAC00 <= c <= 0xDFFF]
    rows = spark.createDataFrame([(c, "a" + chr(c) + "b") for c in codes], "c int, t string")
    for r in rows.selectExpr("c", "t", f"{strip_accents('t')} AS x").collect():
        kept = "".join(ch for ch in unicodedata.normalize("NFKD", r["t"]) if not unicodedata.combining(ch))
        assert r["x"] == kept, hex(r["c"])


def test_whitespace(spark):
    assert one(spark, normalize_whitespace, "   hola    mundo   ") == "hola mundo"
    assert one(spark, normalize_whitespace, "\n\t hola   \t") == "hola"


def test_company(spark):
    r = normalized(spark, "Logistica Retail S.A.", "MORAL")
    assert (r["name_norm"], r["name_base"], r["name_initials"]) == ("logistica retail s.a", "logistica retail", "lr")
    assert (r["name_token_count"], r["name_char_count"], r["removed_legal_suffix_pattern_count"]) == (2, 15, 1)


def test_person(spark):
    r = normalized(spark, "David Smith", "FISICA")
    assert (r["name_base"], r["name_initials"], r["removed_legal_suffix_pattern_count"]) == ("david smith", "ds", 0)
    assert (r["name_token_count"], r["name_char_count"]) == (2, 10)


def test_first_pattern_takes_the_letter_that_a_later_one_needs(spark):
    assert normalized(spark, "Grupo X S.A. de C.V.", "MORAL")["name_base"] == "grupo x de c.v"
    assert len(LEGAL_FORMS) == 13


@pytest.mark.parametrize("name, norm", [(None, ""), ("", ""), ("Москва 公司", ""), ("Ａｃｍｅ ™ ß", "acme"), ("ﬁrma ½", "firma 1 2")])
def test_odd_names(spark, name, norm):
    assert normalized(spark, name, "FISICA")["name_norm"] == norm


def test_no_variants_of_nothing(spark):
    assert variants(spark, "", "FISICA") == {}
    assert variants(spark, "   ", "MORAL") == {}


def test_variants(spark):
    assert "logistica" in variants(spark, "logistica", "MORAL")
    two = variants(spark, "logistica retail", "MORAL")
    assert two == {
        "logistica retail": "base_canonical",
        "retail logistica": "reverse_order",
        "l r": "initials_full",
        "l retail": "first_initial_last",
    }
    assert variants(spark, "apex trading", "MORAL")["apex"] == "moral_remove_corp_noise"
    assert variants(spark, "a", "FISICA") == {"a": "base_canonical"}
