"""Document streams: micro-batch ingestion and first sightings of keys."""
