"""portal_metrics: page-view star-schema analytics as Spark DataFrame programs."""

from .functions.filters import Filters, relative_period
from .model import StarModel

__all__ = ["Filters", "StarModel", "relative_period"]
