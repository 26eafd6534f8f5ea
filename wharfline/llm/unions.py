"""Components of links inside one task."""

from wharfline.functions.unions import link

__all__ = ["link"]
