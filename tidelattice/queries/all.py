"""Importing this module registers every query."""

from . import aggregating, jobs, joining, ordering, regridding, scalars, selecting, sourcing, streams  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
