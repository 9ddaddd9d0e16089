"""Generic operators on DataFrames. Column names are arguments; no register is named here."""

from entityfold.operators.aggregate import (
    awards_by_recipient,
    extract_releases,
    ingest_stats,
    spend_by_supplier,
)
from entityfold.operators.compare import (
    bucket_counts,
    compare_counts,
    reconcile,
    shard_total,
    unattributed_sources,
)
from entityfold.operators.gates import (
    GateError,
    assert_no_fanout,
    assert_unique,
    fanout_report,
    flag_capped_chunks,
    gate_floors,
    require_empty,
)
from entityfold.operators.nest import (
    nest_many,
    nest_one,
    nest_pages,
    oversized_groups,
)
from entityfold.operators.relate import (
    bridge_secondary,
    first_seen,
    hot_keys,
    join_shared,
    latest_per_key,
    lookup_guarded,
    shared_lists,
    two_path,
)
from entityfold.operators.verify import (
    count_on_the_way,
    check_documents,
    check_unique,
    coverage,
    coverage_shortfalls,
    order_breaks,
    percent_coverage,
    rule_counts,
    top_issues,
)

__all__ = [
    "GateError",
    "assert_no_fanout",
    "assert_unique",
    "awards_by_recipient",
    "bridge_secondary",
    "bucket_counts",
    "check_documents",
    "check_unique",
    "compare_counts",
    "count_on_the_way",
    "coverage",
    "coverage_shortfalls",
    "extract_releases",
    "fanout_report",
    "first_seen",
    "flag_capped_chunks",
    "gate_floors",
    "hot_keys",
    "ingest_stats",
    "join_shared",
    "latest_per_key",
    "lookup_guarded",
    "nest_many",
    "nest_one",
    "nest_pages",
    "order_breaks",
    "oversized_groups",
    "percent_coverage",
    "reconcile",
    "require_empty",
    "rule_counts",
    "shard_total",
    "shared_lists",
    "spend_by_supplier",
    "top_issues",
    "two_path",
    "unattributed_sources",
]
