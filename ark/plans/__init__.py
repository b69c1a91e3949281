"""The registered queries: importing the modules fills the registry."""

from . import catalog, identity, reading, roundtrips, upkeep, view_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
