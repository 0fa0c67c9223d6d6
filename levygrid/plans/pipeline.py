"""A whole run, stage by stage, over one set of sheets."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, functions as F

from levygrid import constants as C
from levygrid.config import MatrixConfig
from levygrid.operators import codes, errors, items, records, replicate, report
from levygrid.operators.dimensions import Dimensions
from levygrid.operators.stages import durable


def _as_is(df: DataFrame) -> DataFrame:
    return df


class Run:
    """Lazy stages of a run over named sheet rows.

    ``keep`` says which stages are written once to the checkpoint folder because several
    branches read them: "none"; "records", for the outputs that all come from records;
    "all", for a run that writes every output. ``ordered`` keeps the columns that put
    records into sheet order. ``listing`` has the files that could be read and have a header;
    without it the files are those that have rows.
    """

    def __init__(
        self,
        rows: DataFrame,
        dims: Dimensions,
        config: MatrixConfig,
        keep: str = "none",
        ordered: bool = False,
        listing: DataFrame | None = None,
    ):
        self.dims = dims
        self.config = config
        self.ordered = ordered
        self.listing = listing
        self._keep = durable if keep in ("records", "all") else _as_is
        self._keep_all = durable if keep == "all" else _as_is
        self._rows = rows

    @cached_property
    def rows(self) -> DataFrame:
        return self._keep_all(self._rows)

    @cached_property
    def templates(self) -> DataFrame:
        """Record templates at their geocodes, with and without tax types."""
        return self._keep_all(records.templates(self.rows, self.dims, self.config))

    @cached_property
    def records(self) -> DataFrame:
        typed = records.with_tax_types(self.templates, self.dims.tax_types)
        found = records.as_matrix(typed, self.config)
        return self._keep(found if self.ordered else found.select(*C.MATRIX_COLUMNS))

    @cached_property
    def misses(self) -> DataFrame:
        return records.without_tax_types(self.templates, self.dims.tax_types)

    @cached_property
    def replicated(self) -> DataFrame:
        """Replicated records with their number of ``copies``."""
        return self._keep(replicate.replicated(self.records))

    @cached_property
    def without_state(self) -> DataFrame:
        return self._keep(replicate.cities_without_state(self.records))

    @cached_property
    def candidates(self) -> DataFrame:
        return self._keep(items.valid_candidates(self.rows, self.dims, self.config))

    @cached_property
    def unmapped_ids(self) -> DataFrame:
        """Replicated records carry ids of their originals only, so they need no look."""
        return self._keep(
            codes.unmapped_ids(self.records, self.candidates, codes=self.dims.product_codes)
        )

    @cached_property
    def error_parts(self) -> list[DataFrame]:
        """File, data-quality, replication and code errors, in report order."""
        return [
            errors.file_errors(self.rows, self.dims),
            errors.unknown_status_errors(self.rows, self.dims, self.config),
            errors.missing_tax_type_errors(self.misses),
            errors.replication_errors(self.without_state),
            errors.unmapped_errors(self.unmapped_ids),
        ]

    def errors(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.error_parts)

    def enhanced(self) -> DataFrame:
        """Originals and replicated records, before code conversion."""
        return self.records.select(*C.MATRIX_COLUMNS).unionByName(
            replicate.expand_copies(self.replicated)
        )

    def coded_parts(self) -> tuple[DataFrame, DataFrame]:
        """Originals and, still counted, replicated records with item codes."""
        product_codes = self.dims.product_codes
        return (
            codes.with_item_codes(self.records, product_codes),
            codes.with_item_codes(self.replicated, product_codes),
        )

    def matrix(self) -> DataFrame:
        """The matrix file: originals and replicated records with item codes."""
        originals, copied = self.coded_parts()
        return originals.select(*C.MATRIX_COLUMNS).unionByName(replicate.expand_copies(copied))

    def items(self) -> DataFrame:
        """The product-item file."""
        return items.unique_items(self.rows, self.dims, self.config)

    def batch_summary(self) -> DataFrame:
        """Successful files, their tagged rows, records and items. Empty sheets succeed."""
        good = items.resolved_files_only(self.rows, self.dims.locations)
        per_file = report.rows_processed(good, self.config)
        successful = per_file.select("file_idx")
        if self.listing is not None:
            empty = self.listing.join(
                self.rows.select("file_idx").distinct(), "file_idx", "left_anti"
            )
            successful = successful.unionByName(empty.select("file_idx"))
        return report.counters(
            files_successful=report.count_of(successful),
            rows_processed=report.total_of(per_file, "rows_processed"),
            records_generated=report.count_of(self.records),
            product_items_generated=report.total_of(self.candidates, "copies"),
        )

    def summary(self) -> DataFrame:
        """Counters of the run. ``errors`` counts file and data-quality errors only."""
        product_codes = self.dims.product_codes
        mapped, mapped_copies = self.coded_parts()
        mapped_items = codes.with_item_codes(self.candidates, product_codes)
        files = self.rows.select("file_idx").distinct()
        type_gaps = self.misses.select("file_idx", "geocode", "tax_cat").distinct()
        parts = report.counters(
            files_processed=report.count_of(files),
            original=report.count_of(self.records),
            copied=report.total_of(self.replicated, "copies"),
            original_mapped=report.count_of(mapped),
            copied_mapped=report.total_of(mapped_copies, "copies"),
            product_items_generated=report.total_of(self.candidates, "copies"),
            product_items_with_mapped_codes=report.total_of(mapped_items, "copies"),
            unique_product_items=report.count_of(mapped_items.select("item").distinct()),
            unmapped_research_ids=report.count_of(self.unmapped_ids),
            failed_files=report.count_of(errors.failed_files(self.rows, self.dims)),
            unknown=report.count_of(
                records.unknown_statuses(self.rows, self.dims, self.config)
            ),
            type_gaps=report.count_of(type_gaps),
        )
        generated = F.col("original") + F.col("copied")
        with_codes = F.col("original_mapped") + F.col("copied_mapped")
        return parts.select(
            "files_processed",
            generated.alias("records_generated"),
            with_codes.alias("records_with_mapped_codes"),
            (generated - with_codes).alias("records_excluded"),
            "product_items_generated",
            "product_items_with_mapped_codes",
            (
                F.col("product_items_generated") - F.col("product_items_with_mapped_codes")
            ).alias("product_items_excluded"),
            "unique_product_items",
            "unmapped_research_ids",
            (F.col("failed_files") + F.col("unknown") + F.col("type_gaps")).alias("errors"),
        )

    def mapping_stats(self) -> DataFrame:
        return report.counters(
            total_mappings=report.count_of(self.dims.product_codes.df),
            unmapped_requests=report.count_of(self.unmapped_ids),
        )
