"""Registered queries over the given tables, with the SQL that gives the same rows."""
