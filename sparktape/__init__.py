"""Market-tick analytics on Spark."""

from .plans.store import TickLake
from .schema import FRAME, STORED_TICK, TICK
from .sources.lake import append_ticks, read_ticks

__all__ = ["FRAME", "STORED_TICK", "TICK", "TickLake", "append_ticks", "read_ticks"]
