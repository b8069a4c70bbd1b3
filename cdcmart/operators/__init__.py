"""DataFrame -> DataFrame operators: latest per key, merge, catch-up, checks, marts."""

from .catchup import catch_up
from .checks import ObservedChecks, column_checks, require_checks
from .keys import ConstraintViolation, ObservedConstraints, key_violations, length_violations, require_key
from .latest import first_per_key, latest_per_key
from .materials import material_demand, ordered, unpivot_materials
from .merge import (append_interval, apply_changes, cdc_interval, classify_changes, merge_into_table,
                    merge_outcomes, upsert)
from .sizing import fits_broadcast, measure, measure_many

__all__ = [
    "catch_up", "ObservedChecks", "column_checks", "require_checks", "ConstraintViolation", "key_violations",
    "length_violations", "require_key", "ObservedConstraints", "first_per_key", "latest_per_key",
    "material_demand", "ordered", "unpivot_materials", "append_interval", "apply_changes", "cdc_interval",
    "classify_changes", "merge_into_table", "merge_outcomes", "upsert", "fits_broadcast", "measure",
    "measure_many",
]
