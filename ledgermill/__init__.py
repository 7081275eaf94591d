"""Incremental warehouse for business records on Spark: land, clean, upsert, denormalise, monitor."""
