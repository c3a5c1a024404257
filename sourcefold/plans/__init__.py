"""Queries: operators bound to tables, each with the SQL that gives the same rows."""
