"""All registered queries; importing this package fills the registry."""
from stayflow.queries import categories, cohorts, evaluation, numerics, scalars, selection, statistics, stored  # noqa: F401
from stayflow.queries.registry import ORACLES, QUERIES  # noqa: F401
