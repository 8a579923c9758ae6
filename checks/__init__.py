"""Queries over the test tables, each with the SQL another engine answers it with."""

from checks import (catalog, evolution, extract, generated, history, jobs, loads, reports, runs,  # noqa: F401
                    settings, stage, tables)
from checks.common import REGISTRY

__all__ = ["REGISTRY"]
