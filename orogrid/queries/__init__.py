"""Registered queries: each applies library operators to the supplied tables, with the SQL that says the same."""
