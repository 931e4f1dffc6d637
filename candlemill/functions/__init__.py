"""Column expressions shared by batch and streaming transforms. All are JVM built-ins."""

from .times import AsOf, epoch_millis, latest, trailing, trailing_floor
from .trades import side_of

__all__ = ["AsOf", "epoch_millis", "latest", "side_of", "trailing", "trailing_floor"]
