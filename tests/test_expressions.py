"""Scalar expressions, case by case."""

import decimal
import random

import pytest
from pyspark.sql import functions as F

from levygrid.functions import ids, percent, text, treatment


def values(spark, expression, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, x string")
    return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_strip_removes_every_kind_of_white_space(spark):
    assert values(spark, text.ws, [" a ", "\t\na ", " a b　", "\x1ca\x1f", ""]) == [
        "a", "a", "a b", "a", "",
    ]


def test_cell_access(spark):
    row = spark.sql("SELECT array(' a ', null, 'b') AS cells")
    got = row.select(*[text.cell(F.col("cells"), i) for i in (0, 1, 2, 3, None)]).first()
    assert list(got) == ["a", "", "b", "", ""]


def test_parse_taxable(spark):
    assert values(
        spark, treatment.parse_taxable,
        ["TAXABLE", "Not Taxable", "nontaxable", "Exempt", "Drill Down", "To Research", "x", ""],
    ) == [1, 0, 0, 0, None, None, None, None]


def test_unknown_status(spark):
    assert values(spark, treatment.is_unknown_status, ["Bogus", "Drill Down", "", "taxable"]) == [
        True, False, False, False,
    ]


def test_legacy_status(spark):
    assert values(
        spark, treatment.legacy_taxable_status,
        ["Not Taxable", "Taxable", "TAXABLE", "Drill Down", "exempt", "Exempt"],
    ) == [0, 1, 1, -1, 1, 0]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("100%", "1.000000"), ("8.75%", "0.087500"), ("8.75 %", "0.087500"), ("0%", "0.000000"),
        ("1.0", "1.000000"), ("8.75", "8.750000"), ("150%", "1.500000"), ("1e-2", "0.010000"),
        ("1_0%", "0.100000"), ("-5%", "-0.050000"), (".5", "0.500000"), ("%5%", "0.050000"),
        ("0.0000005", "0.000000"), ("0.0000015", "0.000002"), ("0.0000025", "0.000002"),
        ("", None), ("%", None), ("n/a", None), ("none%", None), ("1,5", None),
    ],
)
def test_percent(spark, given, expected):
    got = values(spark, lambda c: treatment.format_percent(treatment.parse_percent(c)), [given])
    assert got == [expected]


def number(text):
    """What decimal arithmetic makes of a percent text; None if it is none."""
    try:
        value = decimal.Decimal(text.replace("%", ""))
        return value / 100 if "%" in text else value
    except decimal.InvalidOperation:
        return None


def percent_texts():
    draw = random.Random(8)
    out = [
        "0.123456789012345678%", "0.00123456789012345678", "812345678901234567890123456789%", "1e-25%", "-0", "-0%",
        "0e5", "1e-5000", "9" * 40, "9" * 40 + "%", "99999999999999999999999999995%", "0.9999995", "0.99999950001",
        "-0.0000005", "-0.0000004", "12345678901.5", "1" * 28 + "5%", "1" * 27 + "25%", "1e40%", "00012.500", ".", "e5",
        "1e", "+5%", "+-5", "1 2", "0x1", "1e10001", "1e1234567890", "5" + "0" * 30 + "%", "0." + "0" * 30 + "7",
    ]
    for _ in range(400):
        digits = "".join(draw.choice("0059") if draw.random() < 0.7 else draw.choice("12345678") for _ in range(draw.randint(1, 36)))
        at = draw.randint(0, len(digits))
        text = draw.choice(["", "", "-", "+"]) + digits[:at] + draw.choice(["", "."]) + digits[at:]
        out.append(text + draw.choice(["", "", f"e{draw.randint(-40, 12)}"]) + draw.choice(["", "%"]))
    return out


def test_percents_are_exact(spark):
    texts = percent_texts()
    got = values(spark, lambda c: treatment.format_percent(treatment.parse_percent(c)), texts)
    for text, found in zip(texts, got):
        value = number(text)
        if value is not None and value.adjusted() >= percent.MAX_DIGITS:
            value = None
        assert found == (None if value is None else f"{value:.6f}"), text


def test_percents_are_compared_exactly(spark):
    texts = percent_texts()[:120] + ["8.75%", "0.0875", "0.087500", "875e-4", "0", "0.0%"]
    known = [(t, number(t)) for t in texts]
    known = [(t, v) for t, v in known if v is not None and v.adjusted() < percent.MAX_DIGITS]
    pairs = [(a, b, x == y) for a, x in known for b, y in known]
    frame = spark.createDataFrame(pairs, "a string, b string, same boolean")
    found = percent.equal(percent.parse(F.col("a")), percent.parse(F.col("b")))
    wrong = frame.where(~found.eqNullSafe(F.col("same"))).collect()
    assert wrong == [] and sum(p[2] for p in pairs) > len(known)
    none = spark.range(1).select(percent.equal(percent.parse(F.lit("x")), percent.parse(F.lit("1"))).alias("e"))
    assert none.first()["e"] is None


def test_jurisdiction_name(spark):
    assert values(
        spark, text.jurisdiction_name,
        [
            "Illinois Sales Tax Research", " baton rouge sales tax research ",
            "CHICAGOSALES TAX RESEARCH", "Illinois Sales Tax Research 2024",
            "Denver Tax Research", "Sales Tax Research", "", "Ohio Sales Tax Research.xlsx",
            "A Sales Tax Research B Sales Tax Research",
            "A Sales Tax Research Sales Tax Research",
            "A Sales Tax Research Sales Tax Research x Sales Tax Research\u00a0",
            "\u00a0A Sales Tax Research\t", "x" * 20_000 + " Sales Tax Research",
        ],
    ) == [
        "ILLINOIS", "BATON ROUGE", "CHICAGO", None, None, None, None, None, None, "A", "A", "A",
        "X" * 20_000,
    ]


def test_parent_geocode(spark):
    assert values(
        spark, ids.parent_geocode,
        ["US08013A0025", "US17031A0003", "US0800000000", "US08", "AB"],
    ) == ["US0800000000", "US1700000000", "US0800000000", "US0800000000", "AB0000000000"]


def test_normalize_research_id(spark):
    assert values(
        spark, ids.normalize_research_id,
        [
            "1.1.1.4.3.0.0.0", "1.1.0.0.0.0.0.0", "1.0.0.0.0.0.0.0", "1.2.3", "0.0.0.0", "0",
            "", "   ", "1", " 1.0 ", "10.0", "1.00", "1.1.1.4.3.0.0.0.0",
        ],
    ) == ["1.1.1.4.3", "1.1", "1", "1.2.3", "0.0.0.0", "0", "", "", "1", "1", "10", "1.00", "1.1.1.4.3"]


def test_pad_item_code(spark):
    assert values(
        spark, ids.pad_item_code, ["5", "22", "123", "007", "1234", "", None, " 7 ", "-5", "A"]
    ) == ["005", "022", "123", "007", "1234", "000", "000", "007", "-05", "00A"]


def test_ancestor_ids(spark):
    got = values(
        spark, ids.ancestor_ids, ["1.1.1.4.3.0.0.0", "1.0.2", "1", "1.2.3.4.5.6.7.8.9"]
    )
    assert got[0] == [
        "1.0.0.0.0.0.0.0", "1.1.0.0.0.0.0.0", "1.1.1.0.0.0.0.0", "1.1.1.4.0.0.0.0",
    ]
    assert got[1] == ["1.0.0.0.0.0.0.0"]
    assert got[2] == []
    assert len(got[3]) == 7 and got[3][-1] == "1.2.3.4.5.6.7.0"
    assert values(spark, ids.has_ancestors, ["1", "1.0.0", "1.0.2", "0.0.0.0.0.0.0.0.5"]) == [
        False, False, True, False,
    ]


def test_csv_line(spark):
    df = spark.sql("""SELECT 'US' AS a, '' AS b, 'He said "x"' AS c, 1 AS d""")
    line = df.select(text.csv_line(*[F.col(x) for x in "abcd"])).first()[0]
    assert line == '"US","","He said ""x""","1"'


def test_output_folder_name(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:09:00' AS w, timestamp'2024-07-01 12:00:00' AS s")
    got = df.select(*[text.output_folder_name(F.col(c)) for c in "ws"]).first()
    assert list(got) == ["output-20231231-1609", "output-20240701-0500"]
