"""Registered queries. Importing the modules fills the registry."""

from plantlake.queries import (  # noqa: F401
    aggregates, dashboards, datasets, functions, joins, rules, sources, streams)
from plantlake.queries.base import REGISTRY  # noqa: F401
