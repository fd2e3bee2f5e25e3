"""Registered queries: every operator run on the driver tables, with SQL to compare."""
