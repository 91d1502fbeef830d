"""Every query over the driver's tables."""

from statloom.plans import aggregates, association, basics, datachecks, joins, models, ranking, selection  # noqa: F401  they register their queries
from statloom.plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
