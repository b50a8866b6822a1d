"""All queries of the library but those of optional subpackages."""

from __future__ import annotations

from shoal.plans import configs, copies, objects, rules  # noqa: F401  their queries register themselves
from shoal.plans.core import Query, registered


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in registered().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in registered().items() if sql}
