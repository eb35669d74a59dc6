"""Queries over the given star-schema tables, each with the SQL it must equal."""
