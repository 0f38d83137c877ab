"""Edge values of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from widelathe.functions import labels, numbers, text

NBSP = " "


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("value", "wanted"),
    [(" rmps12345x ", "RMPS12345X"), ("cod: RMPS12345X (sede)", "RMPS12345X"), ("RM-PS 123", "RMPS123"), (NBSP, ""), (None, "")],
)
def test_canonical_code(spark, value, wanted):
    assert one(spark, text.canonical_code, value) == wanted


@pytest.mark.parametrize(
    ("mode", "value", "wanted"),
    [
        ("eu", "1.234,56", 1234.56), ("eu", "1234,5", 1234.5), ("eu", "1.234", 1.234), ("eu", "12,5%", 12.5), ("eu", f"1{NBSP}234,5", 1234.5),
        ("eu", "1,234.56", 1.23456), ("eu", "1,234,567", None), ("eu", "n.d.", None), ("eu", "", None), ("eu", "1d", None), ("eu", None, None),
        ("decimal_comma", "230,5", 230.5), ("decimal_comma", "12,5%", 12.5), ("decimal_comma", "n.d.", None), ("decimal_comma", "1.234,5", None),
        ("it_first", "1.234,56", 1234.56), ("it_first", "123,45", 123.45), ("it_first", "1234,5", 1234.5), ("it_first_compat", "1234,5", 123.0),
    ],
)
def test_parse_number(spark, mode, value, wanted):
    assert one(spark, lambda c: numbers.parse_number(c, mode), value) == wanted


@pytest.mark.parametrize(("value", "wanted"), [("1.234", 1234), ("23,4", 234), ("n/a", None), (None, None)])
def test_parse_int(spark, value, wanted):
    assert one(spark, numbers.parse_int, value) == wanted


def test_unknown_mode():
    with pytest.raises(ValueError, match="unknown mode"):
        numbers.parse_number(F.lit("1"), "other")


@pytest.mark.parametrize(("value", "wanted"), [("91-99", "91_99"), ("100 e Lode", "100_e_lode"), ("Non ammessi", "non_ammessi"), ("variabilità", "variabilit"), (" ", ""), (None, None)])
def test_slug(spark, value, wanted):
    assert one(spark, text.slug, value) == wanted


@pytest.mark.parametrize(("value", "wanted"), [("y1", 1), ("Anno 3", 3), ("5° anno", 5), ("2020/21", 2020), ("a.s. 2024/25", 2024), ("10", None), ("", None), (None, None)])
def test_year_index(spark, value, wanted):
    assert one(spark, numbers.year_index, value) == wanted


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize(
    ("value", "wanted"),
    [("Forlì", "FORLI"), ("Citta' di Castello", "CITTA DI CASTELLO"), ("L'Aquila", "L'AQUILA"), ("Reggio nell’Emilia", "REGGIO NELL'EMILIA"), ("Cantù (CO)", "CANTU CO"), (None, None)],
)
def test_place_key(spark, exact, value, wanted):
    assert one(spark, lambda c: text.place_key(c, exact), value) == wanted


@pytest.mark.parametrize(("value", "wanted"), [("184", "00184"), ("123456", ""), ("184.0", ""), ("CH-6900", ""), (" 00184 ", "00184"), (None, "")])
def test_postal_code(spark, value, wanted):
    assert one(spark, text.postal_code, value) == wanted


@pytest.mark.parametrize(("value", "wanted"), [("pc", "Liceo classico"), (" TF", "Istituto tecnico (Informatica e telecomunicazioni)"), ("ZZ", "ZZ"), (None, None)])
def test_map_label(spark, value, wanted):
    assert one(spark, labels.map_label, value) == wanted


def test_split_labels(spark):
    a = one(spark, labels.split_label_a, "licei scientifici - classi seconde | italiano")
    assert tuple(a) == ("licei scientifici", "classi seconde", "italiano", None)
    assert one(spark, labels.split_label_a, "x | y")["error"] and one(spark, labels.split_label_a, None)["error"]
    b = one(spark, labels.split_label_b, "variabilità dei punteggi - istituti tecnici - scuola secondaria di ii grado - classi seconde | italiano | tra le classi")
    assert tuple(b) == ("istituti tecnici", "scuola secondaria di ii grado", "classi seconde", "italiano", "tra le classi", None)
    assert one(spark, labels.split_label_b, "a - b")["error"] == 'not enough " - "'


def test_column_name(spark):
    name = labels.column_name("80_rav_22a1_invalsipunteggiomedio_", *map(F.lit, ("scuola secondaria di ii grado", "", "italiano", "punteggio_medio")))
    assert spark.range(1).select(name).first()[0] == "80_rav_22a1_invalsipunteggiomedio_scuola_secondaria_di_ii_grado_italiano_punteggio_medio_"


def test_variable_slug(spark):
    label = "variabilità dei punteggi - licei - scuola secondaria di ii grado - classi quinte/ultimo anno | italiano | tra le classi"
    assert one(spark, labels.variable_slug, label) == "var_licei_secondaria_di_ii_grado_quinte_ultimo_anno_italiano_tra_le_classi"
    assert one(spark, labels.variable_slug, "label") == "label"
    assert one(spark, labels.variable_slug, "A / B") == "a_b"
    assert one(spark, labels.variable_slug, None) == ""


def test_small_text_functions(spark):
    assert one(spark, lambda c: text.truncate(c, 4), "abcdef") == "abc…"
    assert one(spark, text.safe_name, None) == "x"
    assert one(spark, text.clean_text, f" a{NBSP} \t b ") == "a b"
    assert one(spark, lambda c: text.slug_or(c, "cat_empty", 40), "  ") == "cat_empty"
    assert one(spark, lambda c: labels.readable_report_label(F.lit("2.4.c.1"), c), "a | b | c_d - e") == "c d e"
