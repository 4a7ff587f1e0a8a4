"""Gridloom: spreadsheet models as data, on Spark."""
