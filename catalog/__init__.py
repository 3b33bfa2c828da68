"""Queries over the driver tables, each with the SQL that checks it."""

from catalog import bound  # noqa: F401 - registers the bound tables
from catalog.engine import BOUND, QUERIES, Query, Tables  # noqa: F401
from catalog import marts, operators, reshape, staging, core, reads, analytics, files  # noqa: F401, E402, I001 - register queries
