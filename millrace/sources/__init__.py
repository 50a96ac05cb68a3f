"""Types, table definitions and catalogs."""
