"""Registered queries: the library's operators on the driver's tables, with their SQL."""

from . import audits, models, series, shapes, sheets

MODULES = (series, models, sheets, shapes, audits)
REGISTERED = {name: query for module in MODULES for name, query in module.QUERIES.items()}
