"""Registered queries over the shared test tables, each with its SQL counterpart."""

from larder.catalogue import cleaning, edges, incremental, measures, products, windows
from larder.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "edges", "incremental", "measures", "products", "windows"]
