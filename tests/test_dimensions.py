"""Mapping files and the look-ups made of them."""

from levygrid.operators import dimensions as D
from levygrid.sources import mappings
from tests.fixtures import CODES, GEO, TAX_CATS, TAX_TYPES, counted, table


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_state_and_city_geocodes(spark):
    geo = table(spark, [*GEO, ("US1800000000", "IL", "")], ["geocode", "state", "city"])
    assert counted(D.state_geocodes(geo), "state", "geocode") == {
        ("IL", "US1800000000"): 1, ("CO", "US0800000000"): 1,
    }
    cities = counted(D.city_geocodes(geo), "city", "geocode", "geo_idx")
    assert {c for c in cities if c[0] == "CHICAGO"} == {
        ("CHICAGO", "US17031A0003", 5), ("CHICAGO", "US17031A0047", 6),
        ("CHICAGO", "US17043A0053", 7),
    }


def test_last_description_wins_and_types_are_sorted_sets(spark):
    cats = D.tax_categories(table(spark, TAX_CATS, ["tax_cat", "tax_cat_desc"]))
    assert counted(cats, "tax_cat_desc", "tax_cat") == {
        ("General Sales Tax", "01"): 1, ("Special Tax", "02"): 1,
    }
    types = D.tax_types(table(spark, TAX_TYPES, ["geocode", "tax_cat", "tax_type"])).collect()
    assert {r["geo_key"]: r["tax_types"] for r in types}["US1700000000"] == ["01", "02"]


def test_product_codes(spark):
    codes = D.product_codes(table(spark, CODES, ["research_id", "item"]))
    assert counted(codes, "research_key", "item_code") == {
        ("1.1.1.4.3", "022"): 1, ("1.1.2.1.1", "005"): 1, ("1.1.3.2.1", "123"): 1,
        ("1.1.1", "007"): 1, ("1.1.3", "1234"): 1,
    }


def test_mapping_file(spark, tmp_path):
    path = write(
        tmp_path, "geo.csv",
        "geocode,state,county,city,tax_district,jurisdiction\n"
        'US0000000000,  ,,,,COUNTRY\n"US0100000000","AL",,,,STATE\n'
        "US0400000000,AZ\n US0500000000 , AR ,,\n",
    )
    raw = mappings.read_mapping(spark, path, mappings.GEO_COLUMNS, mappings.GEO_MIN)
    assert counted(raw, "geocode", "state", "city") == {
        ("US0000000000", "", ""): 1, ("US0100000000", "AL", ""): 1,
        ("US0500000000", "AR", ""): 1,
    }
    assert counted(D.state_geocodes(raw), "state") == {("AL",): 1, ("AR",): 1}


def test_order_of_rows_in_a_mapping_file_counts(spark, tmp_path):
    path = write(tmp_path, "cat.csv", '"tax_cat","tax_cat_desc"\n"09","A"\n"01","A"\n"05","a"\n')
    raw = mappings.read_mapping(spark, path, mappings.TAX_CAT_COLUMNS, mappings.TAX_CAT_MIN)
    assert counted(D.tax_categories(raw), "tax_cat_desc", "tax_cat") == {
        ("A", "01"): 1, ("a", "05"): 1,
    }


def test_missing_mapping_file_is_an_empty_table(spark, tmp_path):
    raw = mappings.read_mapping(
        spark, str(tmp_path / "none.csv"), mappings.TAX_TYPE_COLUMNS, mappings.TAX_TYPE_MIN
    )
    assert D.tax_types(raw).count() == 0


def test_all_states_are_known(spark):
    names = D.state_names(spark)
    assert names.count() == 51
    assert counted(names.where("state = 'DC'"), "state_name") == {("DISTRICT OF COLUMBIA",): 1}
