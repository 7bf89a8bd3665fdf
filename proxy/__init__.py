"""The library's jobs over the driver tables: derived inputs, queries and, for
each query, the same result in plain SQL."""

from proxy import feeds, market, mart_inputs, marts, publishing, reconciling, storage  # noqa: F401  (registration)
from proxy.core import QUERIES

__all__ = ["QUERIES"]
