"""DataFrame -> DataFrame operators over logs, catalogs, records and reviews."""
