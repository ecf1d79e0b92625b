"""Every operator run on the test tables, next to the SQL that says what it should give."""

from workload import changes, joins, marts, members, reports, storage  # noqa: F401
from workload.base import CHECKS

__all__ = ["CHECKS"]
