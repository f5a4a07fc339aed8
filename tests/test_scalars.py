"""Edge cases of the scalar functions, expected values written by hand."""

import datetime
import unicodedata

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

from gondola.functions import dates, flags, numbers, retail, text
from gondola.operators import measures

NBSP = " "


def values(spark, function, inputs, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_strip_takes_every_unicode_space(spark):
    assert values(spark, text.strip, [f" {NBSP}a b　\x1c\n", "ñ", "", None]) == ["a b", "ñ", "", None]


def test_missing_markers(spark):
    given = ["", f" {NBSP}", "nan", " NaN ", "None", "nano", "x", None]
    assert values(spark, text.missing_to_null, given) == [None, None, None, None, None, "nano", "x", None]


def test_upper_trim(spark):
    assert values(spark, text.upper_trim, [f"  san {NBSP}\t lorenzo ", None]) == ["SAN LORENZO", None]


def test_strip_accents(spark):
    assert values(spark, text.strip_accents, ["Código Ñandú", "é", "ﬁn ½ Ĳ", None])[:2] == ["Codigo Nandu", "e"]
    assert values(spark, text.strip_accents, ["Ĳ½"]) == ["IJ1⁄2"]


def test_safe_text(spark):
    assert values(spark, text.safe_text, [" 1037911.0 ", "1.05", "a.0", None]) == ["1037911", "1.05", "a.0", None]


def test_barcode_digits(spark):
    given = ["7.84007800047E+12", "00784.0", "EAN 78-4", "abc", "", None, "1E-5", "12.9E0", "1.5e+30", "1e12345", "1e-99999999999999999999", "2e99999999999999999999"]
    expected = ["7840078000470", "00784", "784", None, None, None, "0", "12", "15" + "0" * 29, None, "0", None]
    assert values(spark, numbers.barcode_digits, given) == expected


def test_integer_key(spark):
    given = ["007", "000", "12.0", "7.8E+3", "COD-1", "12 3", "-5", "1.5", None]
    assert values(spark, numbers.integer_key, given) == ["7", "0", "12", "7800", None, None, None, None, None]


def test_store_code_keeps_alphanumeric(spark):
    assert values(spark, numbers.store_code, ["0292", "E0292", None]) == ["292", "E0292", None]


def test_number_or_zero(spark):
    given = ["56.000,75", "1,5", "1.500", "1.2.3", f"1{NBSP}000,5", "-3", "Gs. 7", "1-2", "", None]
    expected = [56000.75, 1.5, 1.5, 0.0, 1000.5, -3.0, 0.7, 0.0, 0.0, 0.0]
    assert values(spark, numbers.number_or_zero, given) == expected


def test_thousands_number(spark):
    given = ["1.500", "56.000,75", "1,5", f" 2{NBSP}0 ", "1d", "x", "", None, "1e3"]
    assert values(spark, numbers.thousands_number, given) == [1500.0, 56000.75, 1.5, 20.0, None, None, None, None, 1000.0]


def test_bad_numbers(spark):
    given = ["1", "-1.5e3", ".5", "1d", "1f", "Infinity", "", "nan", "None", None, "12 u"]
    assert values(spark, numbers.is_bad_number, given) == [False, False, False, True, True, True, False, False, False, False, True]


def test_presentation_text(spark):
    rows = [("85", "YERBA"), ("900,7", "cervezas"), ("12,9", "CAÑA"), ("-3", None), ("", "X"), (None, "X"), ("SURTIDO", "VINO"), ("1.500,0", "X")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c string, k string")
    got = [r[0] for r in df.orderBy("i").select(retail.presentation_text(F.col("c"), F.col("k"))).collect()]
    assert got == ["85 GR.", "900 ML.", "12 ML.", "-3 GR.", "-", "-", "SURTIDO", "1.500,0"]


def test_store_type(spark):
    given = ["mini tienda supermercado", "Tienda", "despensa", "kiosco", None]
    assert values(spark, retail.store_type, given) == ["SUPERMERCADO", "TIENDA", "DESPENSA", "", ""]


def test_month_number_and_name(spark):
    assert values(spark, dates.month_number, [" setiembre ", "Septiembre", "4", "x", None]) == ["9", "9", "4", "x", None]
    day = [datetime.date(2025, 9, 3), datetime.date(2025, 1, 1), None]
    assert values(spark, dates.month_name, day, "date") == ["Septiembre", "Enero", None]


def test_day_rules(spark):
    day = [datetime.date(2025, 1, 1), datetime.date(2024, 3, 15)]
    assert values(spark, dates.target_day, day, "date") == [datetime.date(2024, 12, 31), datetime.date(2024, 3, 15)]
    assert values(spark, dates.previous_month_start, day, "date") == [datetime.date(2024, 12, 1), datetime.date(2024, 2, 1)]
    assert values(spark, dates.next_month_start, day, "date") == [datetime.date(2025, 2, 1), datetime.date(2024, 4, 1)]


def test_date_from_parts(spark):
    rows = [(1, " 2024", "2", "29 "), (2, "2024", "2", "30"), (3, "2024", "x", "1"), (4, None, "1", "1"), (5, "2024.0", "1", "1")]
    df = spark.createDataFrame(rows, "i int, y string, m string, d string").orderBy("i")
    got = [r[0] for r in df.select(dates.date_from_parts(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == [datetime.date(2024, 2, 29), None, None, None, None]


def test_day_month_year(spark):
    given = ["05/03/1998", "5/3/1998", "31/02/1998", "1998-03-05", "05/03/98", None]
    day = datetime.date(1998, 3, 5)
    assert values(spark, dates.day_month_year, given) == [day, day, None, None, None, None]
    assert values(spark, dates.day_month_year_strict, ["05/03/1998", None]) == [day, None]
    with pytest.raises(PySparkException):
        values(spark, dates.day_month_year_strict, ["31/02/1998"])


def test_reparsed_date(spark):
    assert values(spark, dates.reparsed_date, ["2024-01-31", "31/01/2024", None]) == [datetime.date(2024, 1, 31), None, None]


FLAGS = ["TRUE", " Sí ", "x", "t r u e", f"{NBSP}Si", "FALSO", "es verdadero", "0", "1", "2", "Y", "", None]


def test_flags(spark):
    lenient = values(spark, lambda c: flags.approved(c, StringType(), "lenient"), FLAGS)
    assert lenient == [True, True, True, True, True, False, True, False, True, False, True, False, False]
    strict = values(spark, lambda c: flags.approved(c, StringType(), "strict"), FLAGS)
    assert strict == [True, True, False, False, True, False, False, False, True, False, False, False, False]


def test_flag_numbers_and_booleans(spark):
    given = [0.5, 1.0, -1.0, 0.0, float("nan"), None]
    lenient = values(spark, lambda c: flags.approved(c, DoubleType(), "lenient"), given, "double")
    assert lenient == [False, True, True, False, False, False]
    strict = values(spark, lambda c: flags.approved(c, DoubleType(), "strict"), given, "double")
    assert strict == [True, True, True, False, False, False]
    assert values(spark, lambda c: flags.approved(c, BooleanType()), [True, False, None], "boolean") == [True, False, False]


def test_flag_column_is_found_by_its_words():
    assert flags.find_flag_column(["a", "Para Escritura "], "para_escritura") == "Para Escritura "
    assert flags.find_flag_column(["a"], "para_escritura") is None


def test_bounded_measure(spark):
    given = [float("nan"), float("inf"), float("-inf"), -1.0, 5.0, 2e6, None]
    assert values(spark, measures.bounded_measure, given, "double") == [0.0, 0.0, 0.0, 0.0, 5.0, 1_000_000.0, 0.0]


def test_dollars_round_half_to_even_in_binary(spark):
    assert values(spark, measures.dollars, [44038.55, 7900.0, 12345.67, None], "double") == [5.574, 1.0, 1.563, None]


def test_chain_measures(spark):
    df = spark.createDataFrame([("PANALES", 2.0, 30.0, 20.0), ("CIGARRILLOS", 2.0, 30.0, 20.0), ("YERBA", 2.0, 500.0, None)], "c string, u double, g double, p double")
    made = measures.chain_measures(F.col("c"), F.col("u"), F.col("g"), F.col("p"))
    got = {r.c: r for r in df.select("c", *[v.alias(k) for k, v in made.items()]).collect()}
    assert (got["PANALES"].unidades, got["PANALES"].paquetes, got["PANALES"].kilos) == (60.0, 2.0, None)
    assert got["PANALES"].fardos == 30.0 * 2.0 * (30 / 1000000 / 0.0058)
    assert (got["CIGARRILLOS"].cajas, got["CIGARRILLOS"].unidades, got["CIGARRILLOS"].kilos) == (20.0 * 2.0 / 10000, 2.0, None)
    assert (got["YERBA"].kilos, got["YERBA"].fardos, got["YERBA"].cajas) == (1.0, None, None)


def test_accents_of_every_assigned_character(spark):
    given = [chr(c) for c in range(1, 0xF0000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    texts = ["a" + "b".join(given[i:i + 200]) + "c" for i in range(0, len(given), 200)] + ["", "plain", None]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", text.strip_accents(F.col("t")).alias("t"))
    for row in got.collect():
        given = texts[row.i]
        want = given and "".join(c for c in unicodedata.normalize("NFKD", given) if not unicodedata.combining(c))
        assert row.t == want


def test_accents_beyond_latin(spark):
    pairs = {"Ελλάδα": "Ελλαδα", "ёлка Й": "елка И", "ﬁn ½": "fin 1⁄2", "한": "\u1112\u1161\u11ab", "𝐀１": "A1", "कि": "कि", "e\u0301": "e"}
    got = spark.createDataFrame([(k,) for k in pairs], "t string").select("t", text.strip_accents(F.col("t")).alias("p"))
    assert {r.t: r.p for r in got.collect()} == pairs
