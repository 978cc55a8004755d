"""Raw tables: schemas, readers and writers, and projections from a star schema."""
