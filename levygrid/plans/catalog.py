"""Every operator and pipeline as a named query over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from levygrid import constants as C
from levygrid.config import MatrixConfig
from levygrid.functions import ids, percent, text, treatment
from levygrid.operators import codes, dimensions as D, errors, items, records, replicate, report
from levygrid.operators import rows as row_ops
from levygrid.operators.lookup import lookup_join
from levygrid.operators.stages import durable, scratch_path
from levygrid.plans import folder_run
from levygrid.plans.folder_run import run_folder
from levygrid.plans.pipeline import Run
from levygrid.session import tuned
from levygrid.sinks import files
from levygrid.sources import mappings, sheets, tables

CONFIG = MatrixConfig()
Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def tuned_fn(spark: SparkSession, folder: str) -> DataFrame:
        # The result is executed by the caller, so the settings have to stay.
        return fn(tuned(spark).spark, folder)

    _QUERIES[fn.__name__] = tuned_fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _run(spark: SparkSession, folder: str, keep: str = "none") -> Run:
    """``keep`` where more than one branch of the query reads the same stage."""
    dims = tables.dimensions(spark, folder, CONFIG)
    return Run(tables.rows(spark, folder), dims, CONFIG, keep)


def _exported(spark: SparkSession, folder: str, line_breaks: bool = False) -> str:
    """The sheets as CSV in a new scratch folder."""
    path = scratch_path(spark, "sheets")
    tables.export_sheets(spark, folder, path, CONFIG, line_breaks)
    return path


# Sources and headers


@query
def file_listing(spark, folder):
    listing = sheets.list_sheets(spark, _exported(spark, folder))
    return listing.select("file_idx", "file_name")


@query
def sheet_scan(spark, folder):
    scanned = sheets.scan_sheets(spark, _exported(spark, folder), multi_line=False)
    scanned = sheets.data_rows(scanned, CONFIG)
    wanted = {1: "current_id", 3: "level_text", 10: "admin", 11: "business_use", 16: "personal_percent"}
    return scanned.select("file_idx", "row_idx", *[
        text.blank_if_null(F.get("cells", F.lit(i))).alias(name) for i, name in wanted.items()
    ])


@query
def sheet_scan_line_breaks(spark, folder):
    """Rows whose cells hold line breaks, from files that are split anywhere."""
    found = sheets.scan(spark, _exported(spark, folder, line_breaks=True), discard_input=True)
    return sheets.data_rows(found.rows, CONFIG).select(
        "file_idx", "row_idx", *[
            text.blank_if_null(F.get("cells", F.lit(i))).alias(name)
            for i, name in {1: "current_id", 3: "level_text", 16: "personal_percent"}.items()
        ]
    )


@query
def sheet_account(spark, folder):
    """What was read of every sheet: the state of its files, and its rows."""
    found = sheets.scan(spark, _exported(spark, folder, line_breaks=True), discard_input=True)
    states = found.parts.groupBy("file_name").agg(
        F.array_join(F.array_sort(F.collect_set("state")), ",").alias("state"),
        (F.sum("bytes_read") == F.sum("size")).alias("all_bytes"),
    )
    rows = found.rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return states.join(rows, "file_name", "left")


@query
def sheet_row_range(spark, folder):
    part = sheets.row_range(tables.numbered_sheets(spark, folder, CONFIG), 10, 40)
    return part.select("file_idx", "row_idx", F.col("cells")[1].alias("current_id"))


@query
def first_header(spark, folder):
    path = _exported(spark, folder)
    parts = durable(sheets.list_parts(spark, path))
    scanned = sheets.scan(spark, path, multi_line=False, parts=parts).rows
    found = sheets.first_header(scanned, CONFIG, sheets.sheets_of(parts))
    return spark.createDataFrame(list(found.items()), "logical_name string, col_idx int")


@query
def missing_columns(spark, folder):
    mapping = sheets.header_mapping(tables.header_sheets(spark, folder, CONFIG), CONFIG)
    data = sheets.data_rows(tables.numbered_sheets(spark, folder, CONFIG), CONFIG)
    named = sheets.named_rows_per_file(data, mapping, CONFIG)
    return named.groupBy("file_name").agg(
        F.count_if(F.col("personal_use") == "").alias("no_personal_use"),
        F.count_if(F.col("admin") == "").alias("no_admin"),
        F.count(F.lit(1)).alias("n"),
    )


@query
def header_row(spark, folder):
    return sheets.header_texts(tables.header_sheets(spark, folder, CONFIG), CONFIG)


@query
def header_mapping(spark, folder):
    return sheets.header_mapping(tables.header_sheets(spark, folder, CONFIG), CONFIG)


@query
def header_mapping_first(spark, folder):
    config = MatrixConfig(header_duplicates="first")
    return sheets.header_mapping(tables.header_sheets(spark, folder, config), config)


# Dimensions


@query
def mapping_scan(spark, folder):
    path = scratch_path(spark, "mappings")
    tables.export_mappings(spark, folder, path, CONFIG)
    return mappings.dimensions(spark, path, CONFIG).product_codes.plan


@query
def dim_state_geocode(spark, folder):
    return D.state_geocodes(tables.geo(spark, folder))


@query
def dim_state_names(spark, folder):
    """Files named after the built-in state names, found by their postal codes."""
    files, geo = tables.files_of_states(spark, folder)
    found = D.state_locations(D.state_names(spark), D.state_geocodes(geo))
    return (
        row_ops.with_jurisdiction(files).join(F.broadcast(found), "jurisdiction", "left")
        .groupBy("jurisdiction", "geocode").agg(F.count(F.lit(1)).alias("n"))
    )


@query
def dim_city_geocodes(spark, folder):
    return D.city_geocodes(tables.geo(spark, folder))


@query
def dim_tax_cat(spark, folder):
    return D.tax_categories(tables.tax_cats(spark, folder))


@query
def dim_tax_types(spark, folder):
    types = D.tax_types_by_key(tables.tax_types(spark, folder))
    return types.select(
        "geocode", "tax_cat", F.array_join("tax_types", ",").alias("tax_types")
    )


@query
def dim_product_code(spark, folder):
    return D.product_codes(tables.product_codes(spark, folder))


# Row filters


@query
def filter_admin_ci(spark, folder):
    tagged = row_ops.tagged_any_case(tables.rows(spark, folder), CONFIG)
    return tagged.select("file_idx", "current_id", "admin")


@query
def filter_admin_cs(spark, folder):
    tagged = row_ops.tagged_same_case(tables.rows(spark, folder), CONFIG)
    return tagged.select("file_idx", "current_id", "admin")


@query
def city_records(spark, folder):
    found = replicate.city_records(_run(spark, folder).records)
    return found.select(*C.MATRIX_COLUMNS)


# Scalar expressions


@query
def cell_access(spark, folder):
    cells = F.col("cells")
    return tables.sheet_rows(spark, folder).select(
        "file_idx",
        text.cell(cells, 1).alias("current_id"),
        text.cell(cells, 3).alias("level_text"),
        text.cell(cells, 10).alias("admin"),
        text.cell(cells, 11).alias("business_use"),
        text.cell(cells, 99).alias("beyond_row"),
        text.cell(cells, None).alias("unknown_column"),
    )


@query
def parse_taxable(spark, folder):
    business, personal = F.col("business_use"), F.col("personal_use")
    return tables.rows(spark, folder).select(
        business, treatment.parse_taxable(business).alias("business_taxable"),
        personal, treatment.parse_taxable(personal).alias("personal_taxable"),
        treatment.is_unknown_status(business).alias("business_unknown"),
        treatment.is_unknown_status(personal).alias("personal_unknown"),
    )


@query
def taxable_status_legacy(spark, folder):
    business, personal = F.col("business_use"), F.col("personal_use")
    return tables.rows(spark, folder).select(
        business, treatment.legacy_taxable_status(business).alias("business_status"),
        personal, treatment.legacy_taxable_status(personal).alias("personal_status"),
    )


@query
def parse_percent(spark, folder):
    business, personal = F.col("business_percent_tax"), F.col("personal_percent_tax")
    return tables.rows(spark, folder).select(
        business.alias("business_text"),
        percent.formatted(percent.parse(business), 20).alias("business_value"),
        personal.alias("personal_text"),
        percent.formatted(percent.parse(personal), 20).alias("personal_value"),
    )


@query
def format_percent(spark, folder):
    value = F.col("l_orderkey").cast("decimal(20,0)") * F.lit("0.0000005").cast("decimal(7,7)")
    return tables.table(spark, folder, "lineitem").select(
        "l_orderkey", treatment.format_percent(percent.parse(value.cast("string"))).alias("percent_text")
    )


@query
def tax_cat_code(spark, folder):
    run = _run(spark, folder)
    coded = records.with_tax_cat(run.rows, "personal_tax_cat", "personal_code", run.dims.tax_cats)
    coded = records.with_tax_cat(coded, "business_tax_cat", "business_code", run.dims.tax_cats)
    return coded.select("personal_tax_cat", "personal_code", "business_tax_cat", "business_code")


@query
def jurisdiction_name(spark, folder):
    name = F.col("file_name")
    named = tables.sheet_rows(spark, folder).groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n")
    )
    return named.select(
        name, "n",
        text.jurisdiction_name(name).alias("jurisdiction"),
        text.jurisdiction_name(F.concat(name, F.lit(" 2024"))).alias("with_year"),
        text.jurisdiction_name(F.concat(F.lit(" "), name, F.lit("\t"))).alias("padded"),
        text.jurisdiction_name(
            F.regexp_replace(name, "^.*(Sales Tax Research)$", "$1")
        ).alias("bare"),
    )


@query
def parent_geocode(spark, folder):
    code = F.col("geocode")
    return tables.geo(spark, folder).select(
        code, ids.parent_geocode(code).alias("parent"),
        ids.parent_geocode(F.substring(code, 1, 2)).alias("parent_of_short"),
    )


@query
def normalize_research_id(spark, folder):
    key = F.col("p_partkey")
    rid = tables.research_id(key)
    zeros = F.concat(F.lit("0"), F.repeat(F.lit(".0"), (key % 3).cast("int")))
    return tables.table(spark, folder, "part").select(
        key, rid.alias("research_id"), ids.normalize_research_id(rid).alias("normalized"),
        ids.normalize_research_id(zeros).alias("zeros"),
    )


@query
def pad_item_code(spark, folder):
    key = F.col("p_partkey")
    return tables.table(spark, folder, "part").select(
        key, ids.pad_item_code(key.cast("string")).alias("code")
    )


@query
def ancestor_ids(spark, folder):
    key = F.col("p_partkey")
    return tables.table(spark, folder, "part").select(
        key, F.posexplode(ids.ancestor_ids(tables.research_id(key))).alias("pos", "ancestor")
    )


@query
def row_description(spark, folder):
    return tables.rows(spark, folder).select("file_idx", "current_id", "description")


@query
def hier_description(spark, folder):
    run = _run(spark, folder)
    wanted = items.candidates(run.rows, run.dims, CONFIG).select("file_idx", "item").distinct()
    return items.hierarchical(wanted, items.descriptions(run.rows), CONFIG)


@query
def treatment_dedup(spark, folder):
    run = _run(spark, folder)
    return records.parsed_sides(run.rows, CONFIG, run.dims.tax_cats).select(
        "file_idx", "item", "business_valid", "personal_valid",
        F.coalesce(records.same_treatment(), F.lit(False)).alias("identical"),
    )


@query
def row_to_records(spark, folder):
    run = _run(spark, folder)
    sides = records.treatments(records.parsed_sides(run.rows, CONFIG, run.dims.tax_cats))
    return sides.select(
        "file_idx", "item", "customer", "taxable", "tax_cat", "percent_taxable"
    )


@query
def matrix_csv_line(spark, folder):
    found = _run(spark, folder).records
    return found.select(text.csv_line(*[F.col(c) for c in C.MATRIX_COLUMNS]).alias("line"))


@query
def item_csv_line(spark, folder):
    found = _run(spark, folder).items()
    quoted = F.concat(F.lit('"'), F.col("description"))
    return found.select(text.csv_line(F.col("group"), F.col("item"), quoted).alias("line"))


@query
def output_folder_name(spark, folder):
    return tables.table(spark, folder, "events").select(
        "event_id", text.output_folder_name(F.col("ts").cast("timestamp")).alias("folder")
    )


# Joins


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return tables.sheet_rows(spark, folder).select("file_idx", "file_name").distinct()


@query
def resolve_geocodes(spark, folder):
    run = _run(spark, folder)
    named = row_ops.with_jurisdiction(_files(spark, folder))
    keys = {"jurisdiction": F.col("jurisdiction")}
    found = lookup_join(named, run.dims.locations, keys, "left", ["file_idx"])
    return found.select("file_idx", "file_name", "geocode")


@query
def resolve_state_geocode(spark, folder):
    states = D.state_locations(
        tables.state_names(spark, folder), D.state_geocodes(tables.geo(spark, folder))
    )
    named = row_ops.with_jurisdiction(_files(spark, folder))
    return named.join(states, "jurisdiction", "left").select("file_idx", "file_name", "geocode")


@query
def multi_geocode(spark, folder):
    run = _run(spark, folder)
    return run.templates.select(
        "file_idx", "geocode", "item", "customer", "taxable", "tax_cat", "percent_taxable"
    )


@query
def expand_tax_types(spark, folder):
    run = _run(spark, folder)
    found = records.with_tax_types(
        run.templates, run.dims.tax_types
    )
    return found.select("file_idx", "geocode", "item", "customer", "tax_cat", "tax_type")


@query
def missing_tax_types(spark, folder):
    return _run(spark, folder).misses.select("file_idx", "geocode", "item", "customer", "tax_cat")


@query
def expand_tax_types_default(spark, folder):
    run = _run(spark, folder)
    found = records.with_default_tax_types(
        run.templates, run.dims.tax_types
    )
    return found.select("file_idx", "geocode", "item", "customer", "tax_cat", "tax_type")


@query
def sheet_matrix(spark, folder):
    return _run(spark, folder).records.select(*C.MATRIX_COLUMNS)


@query
def replicate_state(spark, folder):
    return replicate.expand_copies(_run(spark, folder, keep="records").replicated)


@query
def city_without_state(spark, folder):
    return _run(spark, folder, keep="records").without_state.select(
        "geocode", "group", "item", "customer", "provider", "tax_type", "tax_cat", "n"
    )


@query
def enhanced_records(spark, folder):
    return _run(spark, folder, keep="records").enhanced()


@query
def convert_records(spark, folder):
    run = _run(spark, folder)
    return codes.with_item_codes(run.records, run.dims.product_codes).select(*C.MATRIX_COLUMNS)


@query
def convert_items(spark, folder):
    run = _run(spark, folder)
    found = items.product_items(run.rows, run.dims, CONFIG)
    coded = codes.with_item_codes(found, run.dims.product_codes)
    return replicate.expand_copies(coded.select(*C.ITEM_COLUMNS, "copies"))


@query
def unmapped_ids(spark, folder):
    return _run(spark, folder, keep="records").unmapped_ids


# Aggregates and reports


@query
def missing_tax_type_errors(spark, folder):
    return errors.missing_tax_type_errors(_run(spark, folder).misses)


@query
def city_error_summary(spark, folder):
    return errors.replication_errors(_run(spark, folder, keep="records").without_state)


@query
def file_errors(spark, folder):
    run = _run(spark, folder)
    return errors.file_errors(run.rows, run.dims)


@query
def unknown_taxable_errors(spark, folder):
    run = _run(spark, folder)
    return errors.unknown_status_errors(run.rows, run.dims, CONFIG)


@query
def errors_report(spark, folder):
    return _run(spark, folder, keep="all").errors()


@query
def mapping_stats(spark, folder):
    return _run(spark, folder, keep="records").mapping_stats()


@query
def rows_processed(spark, folder):
    return report.rows_processed(tables.rows(spark, folder), CONFIG)


@query
def batch_summary(spark, folder):
    return _run(spark, folder, keep="records").batch_summary()


@query
def run_summary(spark, folder):
    return _run(spark, folder, keep="all").summary()


@query
def dedup_items(spark, folder):
    run = _run(spark, folder)
    found = items.product_items(run.rows, run.dims, CONFIG)
    coded = codes.with_item_codes(found, run.dims.product_codes)
    return items.first_per_code(coded, "file_idx", "description")


# Whole pipelines and sinks


@query
def product_items(spark, folder):
    run = _run(spark, folder)
    found = items.product_items(run.rows, run.dims, CONFIG)
    return replicate.expand_copies(found.select("file_idx", *C.ITEM_COLUMNS, "copies"))


@query
def matrix_update(spark, folder):
    return _run(spark, folder, keep="records").matrix()


@query
def product_item_update(spark, folder):
    return _run(spark, folder).items()


def _matrix_schema() -> str:
    return ", ".join(f"`{c}` {'int' if c == 'taxable' else 'string'}" for c in C.MATRIX_COLUMNS)


@query
def write_matrix(spark, folder):
    path = scratch_path(spark, "matrix_update.csv")
    files.write_csv(_run(spark, folder, keep="records").matrix(), path)
    return files.read_csv(spark, path, _matrix_schema())


@query
def write_items(spark, folder):
    path = scratch_path(spark, "product_item_update.csv")
    files.write_csv(_run(spark, folder).items(), path)
    return files.read_csv(spark, path, ", ".join(f"`{c}` string" for c in C.ITEM_COLUMNS))


@query
def matrix_order(spark, folder):
    """The matrix as one ordered file: places of the originals in it; replicated records follow."""
    run = Run(
        tables.rows(spark, folder), tables.dimensions(spark, folder, CONFIG), CONFIG, keep="records", ordered=True
    )
    path = scratch_path(spark, "matrix_update.csv")
    folder_run.write_matrix(run, path, one_header=True)
    read = files.read_joined(spark, path, _matrix_schema())
    originals = run.coded_parts()[0].count()
    place = F.when(F.col("position") <= originals, F.col("position"))
    return read.withColumn("position", place)


@query
def item_order(spark, folder):
    """The item file as one ordered file: every row with its place."""
    path = scratch_path(spark, "product_item_update.csv")
    files.write_csv(_run(spark, folder).items(), path, [F.col("item")], one_header=True)
    return files.read_joined(spark, path, ", ".join(f"`{c}` string" for c in C.ITEM_COLUMNS))


@query
def error_document(spark, folder):
    """The error document's entries and ids by line, read back from its ordered parts."""
    run = _run(spark, folder, keep="all")
    path = scratch_path(spark, "errors_document.json")
    files.write_error_document(run.error_parts, run.unmapped_ids, F.lit("2024-01-01").cast("timestamp"), path)
    text = F.regexp_replace(F.regexp_replace("value", "^,", ""), r',"research_ids":\[$', "}")
    entry = F.from_json(text, "error_type string, file_name string, error_message string, impact string")
    lines = spark.read.text(path).withColumn("entry", entry)
    found = lines.where(F.col("entry.error_type").isNotNull()).select("entry.*", F.lit(None).cast("string").alias("research_id"))
    ids = lines.where(F.col("value").rlike('^,?"')).select(
        *[F.lit(None).cast("string").alias(c) for c in found.columns[:4]],
        F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")[0].alias("research_id"),
    )
    return found.unionByName(ids)


@query
def write_errors(spark, folder):
    run = _run(spark, folder, keep="all")
    path = scratch_path(spark, "errors.json")
    files.write_errors(run.error_parts, run.unmapped_ids, path)
    schema = "error_type string, file_name string, error_message string, impact string, research_id string"
    return spark.read.schema(schema).json(path).drop("section")


@query
def folder_matrix(spark, folder):
    """A whole run over CSV files; its matrix, read back."""
    base = scratch_path(spark, "folder")
    tables.export_sheets(spark, folder, f"{base}/sheets", CONFIG)
    tables.export_mappings(spark, folder, f"{base}/mappings", CONFIG)
    found = run_folder(
        spark, f"{base}/sheets", f"{base}/mappings", f"{base}/out", CONFIG, multi_line=False,
        names=tables.state_names(spark, folder),
    )
    return files.read_csv(spark, found["matrix"], _matrix_schema())
