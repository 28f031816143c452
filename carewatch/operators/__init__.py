"""DataFrame operators: contracts, joins, sets, aggregates, ranking, quality checks."""

from . import aggs, contracts, joins, quality, ranking, sets  # noqa: F401
