"""Product items: descriptions, validity, codes, keep-first."""

from levygrid.operators import codes, items
from levygrid.plans.pipeline import Run
from tests.fixtures import CONFIG, counted, dimensions, named, row

G = "General Sales Tax"


def run(spark, rows):
    return Run(named(spark, rows), dimensions(spark), CONFIG)


def described(spark, rows):
    r = run(spark, rows)
    found = items.product_items(r.rows, r.dims, CONFIG)
    return {(x["item"], x["description"], x["copies"]) for x in found.collect()}


def test_ancestors_of_the_same_sheet_are_joined(spark):
    rows = [
        row("1.0.0.0.0.0.0.0", admin="", description="Tech"),
        row("1.1.0.0.0.0.0.0", admin="Section", description=""),
        row("1.1.1.0.0.0.0.0", description="Cloud"),
        # Same id in another sheet: not used by the first one.
        row("1.1.0.0.0.0.0.0", description="Other", file="Illinois"),
    ]
    assert described(spark, rows) == {
        ("1.1.1.0.0.0.0.0", "Tech |   | Cloud", 1),
        ("1.1.0.0.0.0.0.0", "| Other", 1),
    }


def test_last_text_of_an_id_wins_and_repeats_are_kept(spark):
    rows = [
        row("1.1.1.0.0.0.0.0", description="first"),
        row("1.1.1.0.0.0.0.0", description="last"),
    ]
    assert described(spark, rows) == {("1.1.1.0.0.0.0.0", "|   | last", 2)}


def test_blank_description_drops_only_ids_without_ancestors(spark):
    rows = [row("5", description=""), row("5.1", description=""), row("6", description="six")]
    assert described(spark, rows) == {("5.1", "|", 1), ("6", "six", 1)}
    r = run(spark, rows)
    valid = items.valid_candidates(r.rows, r.dims, CONFIG)
    assert counted(valid, "item", "copies") == {("5.1", 1): 1, ("6", 1): 1}


def test_tag_case_and_uncertain_rows(spark):
    rows = [
        row("1", description="a"),
        row("2", description="b", admin="TAG LEVEL"),
        row("3", ("Drill Down", G, "1"), ("Taxable", G, "1"), description="c"),
        row("4", ("Taxable", G, "1"), ("TO RESEARCH", G, "1"), description="d"),
        row("7", ("", G, "1"), ("Bogus", G, "1"), description="e"),
        row("", description="f"),
    ]
    assert {i for i, _, _ in described(spark, rows)} == {"1", "7"}


def test_failed_file_yields_no_items(spark):
    assert described(spark, [row("1", description="a", file="Atlantis")]) == set()


def test_first_item_of_a_code_wins_in_file_then_row_order(spark):
    rows = [
        row("1.1.1.4.3.0.0.0", description="Illinois one", file="Illinois"),
        row("1.1.1.4.3", description="Chicago one", file="Chicago"),
        row("1.1.1.4.3.0", description="Chicago two", file="Chicago"),
        row("1.1.2.1.1", description="five", file="Illinois"),
        row("8.8", description="unmapped", file="Illinois"),
    ]
    r = run(spark, rows)
    found = {(x["group"], x["item"], x["description"]) for x in r.items().collect()}
    assert found == {
        ("7777", "022", "|   |   |   | Chicago one"), ("7777", "005", "|   |   |   | five"),
    }
    assert {x[0] for x in r.unmapped_ids.collect()} == {"8.8"}


def test_codes_ignore_trailing_zeros_and_last_mapping_wins(spark):
    ids = ["1.1.1.4.3" + ".0" * n for n in range(5)] + ["1.1.1", "1.1.3", "9.9", "1.1"]
    df = spark.createDataFrame([(i,) for i in ids], "item string")
    dims = dimensions(spark)
    coded = codes.with_item_codes(df, dims.product_codes)
    assert counted(coded, "item") == {("022",): 5, ("007",): 1, ("1234",): 1}
    assert counted(codes.unmapped_ids(df, df, codes=dims.product_codes), "research_id") == {
        ("9.9",): 1, ("1.1",): 1,
    }


def test_ancestors_are_looked_up_once_for_all_ids_below_them(spark, monkeypatch):
    """Forty ids under one list of four ancestors need four texts, not 160."""
    looked_up, join = [], items.lookup_join

    def counting(facts, *rest):
        if "step" in facts.columns:
            looked_up.append(facts.count())
        return join(facts, *rest)

    monkeypatch.setattr(items, "lookup_join", counting)
    rows = [row("1.1.1.0.0.0.0.0", admin="", description="Cloud")]
    rows += [row(f"1.1.1.1.{i}.0.0.0", description=f"own {i}") for i in range(1, 41)]
    assert described(spark, rows) == {
        (f"1.1.1.1.{i}.0.0.0", f"|   | Cloud |   | own {i}", 1) for i in range(1, 41)
    }
    assert looked_up == [4]
