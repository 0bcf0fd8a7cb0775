"""Queries on the driver's tables: adapters that read them as forecast data, and the same results as SQL."""
