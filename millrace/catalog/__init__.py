"""Every operator as a query over the provided tables, with its check SQL."""

from millrace.catalog import cleaning, encoding, features, modeling, profiling, relations, sources, splitting
from millrace.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "cleaning", "encoding", "features", "modeling", "profiling", "relations", "sources", "splitting"]
