"""Registered queries: every operator run on the given tables, with SQL to compare against."""
