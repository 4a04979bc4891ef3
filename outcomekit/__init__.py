"""outcomekit — tabular outcome analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame``.  Fitted state
(missing rates, fill values, scaler moments, class stats, thresholds) is
itself a small DataFrame with one row per feature / class / model, so it
can be inspected, joined back, persisted and checked against plain SQL.
"""

from outcomekit.config import Roles, DEFAULT_ROLES

__all__ = ["Roles", "DEFAULT_ROLES"]
