from eventide.plans.jobs import QUERIES
from eventide.plans.oracle import ORACLE

__all__ = ["QUERIES", "ORACLE"]
