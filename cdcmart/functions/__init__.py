"""Column-level functions: intervals, dates, recipes."""

from .interval import Interval, bound_literal, days, in_interval, interval_predicate, month_path, parse_date, today_midnight
from .recipes import MATERIALS, RECIPES, demand_number, demand_rejects, expand_materials, material_columns

__all__ = [
    "Interval", "bound_literal", "days", "in_interval", "interval_predicate", "month_path",
    "parse_date", "today_midnight", "MATERIALS", "RECIPES", "demand_number", "demand_rejects",
    "expand_materials", "material_columns",
]
