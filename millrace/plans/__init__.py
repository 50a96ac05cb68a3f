"""Query plans of the catalogue: each is a Spark plan and the SQL that gives the same rows."""
