"""The registered queries: every operator over whole tables, with the SQL it must agree with."""

from . import cleaning, marketing, operations, quality, sales, sinks, sources, streams, support
from .registry import REGISTRY

__all__ = ["REGISTRY", "cleaning", "marketing", "operations", "quality", "sales", "sinks",
           "sources", "streams", "support"]
