"""The registered queries. Importing the modules fills the registry."""

from tablestream.plans import (  # noqa: F401
    checks,
    layouts,
    live,
    messages,
    streams,
    versions,
    windows,
)
from tablestream.plans.registry import QUERIES

__all__ = ["QUERIES"]
