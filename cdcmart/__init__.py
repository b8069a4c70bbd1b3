"""cdcmart: daily change capture and demand marts on Spark DataFrames."""

from .functions import Interval, in_interval
from .operators import (apply_changes, catch_up, cdc_interval, column_checks, first_per_key, latest_per_key,
                        material_demand, upsert)

__all__ = ["Interval", "in_interval", "apply_changes", "catch_up", "cdc_interval", "column_checks",
           "first_per_key", "latest_per_key", "material_demand", "upsert"]
