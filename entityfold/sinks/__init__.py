"""Writers: JSON lines, ordered shards per bucket, metadata, manifest, bundle, reports."""

from entityfold.sinks.shards import (
    build_manifest,
    json_line,
    merge_shards,
    read_shards,
    shard_order_breaks,
    write_awards,
    write_bundle,
    write_comparison,
    write_metadata,
    write_ndjson,
    write_shards,
)

__all__ = [
    "build_manifest",
    "json_line",
    "merge_shards",
    "read_shards",
    "shard_order_breaks",
    "write_awards",
    "write_bundle",
    "write_comparison",
    "write_metadata",
    "write_ndjson",
    "write_shards",
]
