"""Event streams: topics, envelope, validation, deduplication, live health."""
