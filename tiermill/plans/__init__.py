"""The concrete tables: schemas, builders, checks and the ordered run."""
