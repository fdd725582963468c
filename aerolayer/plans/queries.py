"""All driver queries of the engine proper, and their SQL."""

from . import listing_queries, raster_queries, record_queries

QUERIES = record_queries.QUERIES | raster_queries.QUERIES | listing_queries.QUERIES
SQL = record_queries.SQL | raster_queries.SQL | listing_queries.SQL
