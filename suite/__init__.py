"""Registered queries over the driver tables, each beside the SQL that gives the same rows."""
