"""All queries of the library and their SQL."""

from . import catalogue, records

QUERIES = catalogue.QUERIES | records.QUERIES
SQL = catalogue.SQL | records.SQL
