"""The named queries of all modules."""

from docklake.catalog import cubes, feeds, geography, streams, warehouse  # noqa: F401
from docklake.catalog.registry import QUERIES  # noqa: F401
