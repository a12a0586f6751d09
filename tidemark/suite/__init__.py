"""Registered queries: importing this package fills ``registry.REGISTRY``."""

from . import insights, market, reports, serving, streams, warehouse, wire  # noqa: F401
