"""Writing the published tables."""

from .order import with_position
from .report import Deck, write_by_region, write_points, write_report

__all__ = ["Deck", "with_position", "write_by_region", "write_points", "write_report"]
