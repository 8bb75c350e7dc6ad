"""The queries on the test tables, each next to the SQL it must agree with."""

from . import rows, storage, views  # noqa: F401  (they register their queries)
from . import boards, loads  # noqa: F401  (after storage, whose SQL they share)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
