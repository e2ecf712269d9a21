"""Plans over the driver tables: the test views, the registered queries, the pipeline."""
