"""All registered queries."""

from miasma.plans import queries_data, queries_features, queries_model, queries_series, queries_streaming  # noqa: F401
from miasma.plans.registry import ORACLES, QUERIES  # noqa: F401
