"""Gridded-forecast analytics on PySpark: decoded forecast messages to a partitioned store, and queries on it."""

from gridlake.plans.convert import convert
from gridlake.plans.store import GridStore, open_store
from gridlake.rules import Rules, default_rules, load_rules
from gridlake.session import apply_settings

__all__ = ["GridStore", "Rules", "apply_settings", "convert", "default_rules", "load_rules", "open_store"]
