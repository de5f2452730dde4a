"""Table sinks on partitioned Parquet: slice replacement, full replacement,
schema evolution, upsert, column and table comments, JSON documents."""
