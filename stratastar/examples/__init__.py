"""Registered queries over the given tables, each with the SQL that checks it."""

from stratastar.examples import access, calendar, columns, property_model, star
from stratastar.examples.registry import ORACLES, QUERIES, Tables

__all__ = ["ORACLES", "QUERIES", "Tables", "access", "calendar", "columns", "property_model", "star"]
