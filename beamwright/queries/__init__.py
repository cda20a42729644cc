"""Registered queries and their check SQL."""

from beamwright.queries import imaging, relational, scalars, streams  # noqa: F401
from beamwright.queries.core import QUERIES, SQL  # noqa: F401
