"""Document ingest and utility-bill analytics as Spark DataFrame and stream functions."""
