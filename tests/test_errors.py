"""Errors as rows, counters and summaries."""

from levygrid.plans.pipeline import Run
from levygrid.operators import errors
from tests.fixtures import CONFIG, counted, dimensions, named, row

G = "General Sales Tax"


def run(spark, rows, **kwargs):
    return Run(named(spark, rows), dimensions(spark), CONFIG, **kwargs)


def test_unknown_status_once_per_geocode_row_and_side(spark):
    r = run(spark, [row("1.1", ("Maybe", G, "1"), ("maybe", G, "1")), row("1.2", admin="x")])
    parts = r.error_parts
    found = counted(parts[1], "error_type", "file_name", "error_message")
    assert sum(found.values()) == 6
    assert {m for _, _, m in found} == {
        f"Unknown taxable value '{t}' (normalized: 'MAYBE'). Known values: ['NOT TAXABLE', "
        "'NONTAXABLE', 'EXEMPT', 'TAXABLE']. Uncertain values (skipped): ['DRILL DOWN', "
        "'TO RESEARCH']"
        for t in ("Maybe", "maybe")
    }


def test_missing_types_are_summed_up_per_key_in_row_order(spark):
    rows = [row(f"1.{i}", file="Denver") for i in (9, 3, 7, 1, 5, 2, 8)]
    rows.append(row("1.4", ("Taxable", "X", "1"), ("", "", ""), file="Denver"))
    got = {x["error_message"] for x in errors.missing_tax_type_errors(run(spark, rows).misses).collect()}
    assert got == {
        "No tax types found for geocode='US08031A0002', tax_cat='01' - excluded 7 records from "
        "output. Affected items: 1.9, 1.3, 1.7, 1.1, 1.5 ... and 2 more",
        "No tax types found for geocode='US08031A0002', tax_cat='X' - excluded 1 records from "
        "output. Affected items: 1.4",
    }


def test_first_n_is_limited_before_the_shuffle(spark):
    misses = run(spark, [row("1.1", file="Denver")]).misses
    plan = errors.missing_tax_types(misses)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_failed_files(spark):
    r = run(spark, [row("1.1", file="Atlantis"), row("1.2", file="Atlantis"), row("1.3")])
    assert counted(r.error_parts[0], "error_message") == {
        ("Could not determine geocode(s) for filename: Atlantis Sales Tax Research",): 1
    }


def test_summaries(spark):
    rows = [
        row("1.1.1.4.3.0.0.0", description="a"),
        row("1.1.1.4.3", description="a", file="Illinois"),
        row("8.8", description="b"),
        row("1.1.2.1.1", description="c", file="Denver"),
        row("1.1.2.1.1", ("What", G, "1"), description="d", file="Boulder"),
        row("1.1", description="e", file="Atlantis"),
        row("1.1", description="f", admin="tag level"),
    ]
    for keep in ("none", "all"):
        r = run(spark, rows, keep=keep)
        assert r.batch_summary().first().asDict() == {
            "files_successful": 4, "rows_processed": 5, "records_generated": 11,
            "product_items_generated": 5,
        }
        assert r.summary().first().asDict() == {
            "files_processed": 5, "records_generated": 11, "records_with_mapped_codes": 5,
            "records_excluded": 6, "product_items_generated": 5,
            "product_items_with_mapped_codes": 4, "product_items_excluded": 1,
            "unique_product_items": 2, "unmapped_research_ids": 2, "errors": 4,
        }
        assert r.mapping_stats().first().asDict() == {
            "total_mappings": 5, "unmapped_requests": 2,
        }
