"""The shipping of the package, under the name by which the corpus operators know it."""

from sparkmon.shipping import ship

__all__ = ["ship"]
