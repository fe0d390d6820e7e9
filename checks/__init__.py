"""Registered queries over the given tables, each with SQL that a second engine can run."""
