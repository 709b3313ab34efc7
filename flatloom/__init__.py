"""Turn nested JSON documents into clean, deduplicated relational tables with Spark."""
