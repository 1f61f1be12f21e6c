"""cellforge: wide-column cell loading on Spark.

Text lines and typed rows become sparse cells ``(row, family, qualifier, ts, value)``;
cells are merged by version, scanned by column, family, key range and region, studied
by key distribution, and written as range-partitioned, key-sorted files.  Every
operator is a ``DataFrame -> DataFrame`` or ``Column -> Column`` function on Spark's
public API.
"""

from cellforge.functions.scalars import flat_to_millis, row_json, tuple_json
from cellforge.functions.split import java_split
from cellforge.operators.audit import lookup_audit, with_row_number
from cellforge.operators.cells import (
    adjacency_cells,
    bulk_cells,
    composite_key_cells,
    edge_cells,
    file_cells,
    table_cells,
)
from cellforge.operators.files import write_partitioned_cells, write_sorted_cells
from cellforge.operators.keyspace import (
    assign_partition,
    benford_cdf,
    partition_histogram,
    place_by_partition,
    sampled_cdf,
)
from cellforge.operators.rejects import count_rejects
from cellforge.operators.relations import follow_cells, follow_rejects, mention_cells, mention_rejects
from cellforge.operators.scan import (
    get_row,
    limit_per_region,
    region_of,
    scan_cells,
    scan_columns,
    scan_family,
    scan_typed,
)
from cellforge.operators.tables import (
    append_delta,
    compact,
    load_cell_table,
    read_merged,
    save_cell_table,
    upsert_table,
)
from cellforge.operators.tuples import store_bag, store_dynamic, store_rows
from cellforge.operators.versions import collapse_cells, latest_cells, upsert_cells
from cellforge.schema import CELL, CELL_COLUMNS
from cellforge.sources.cells import read_cells
from cellforge.sources.text import read_key_list, read_lines, read_sample_counts, read_typed_tsv

__all__ = [
    "CELL",
    "CELL_COLUMNS",
    "adjacency_cells",
    "append_delta",
    "assign_partition",
    "benford_cdf",
    "bulk_cells",
    "collapse_cells",
    "compact",
    "composite_key_cells",
    "count_rejects",
    "edge_cells",
    "file_cells",
    "flat_to_millis",
    "get_row",
    "follow_cells",
    "follow_rejects",
    "java_split",
    "latest_cells",
    "limit_per_region",
    "load_cell_table",
    "lookup_audit",
    "mention_cells",
    "mention_rejects",
    "partition_histogram",
    "place_by_partition",
    "read_cells",
    "read_key_list",
    "read_lines",
    "read_merged",
    "read_sample_counts",
    "read_typed_tsv",
    "region_of",
    "row_json",
    "sampled_cdf",
    "save_cell_table",
    "scan_cells",
    "scan_columns",
    "scan_family",
    "scan_typed",
    "store_bag",
    "store_dynamic",
    "store_rows",
    "table_cells",
    "tuple_json",
    "upsert_cells",
    "upsert_table",
    "with_row_number",
    "write_partitioned_cells",
    "write_sorted_cells",
]
