"""Page image sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Long-edge cap, largest enlargement and billing tile, in pixels.
MAX_PAGE_PX = 1536
MAX_ZOOM = 4.0
TILE_PX = 768


def page_zoom(width: Column, height: Column, max_px: int = MAX_PAGE_PX) -> Column:
    """Scale that brings the long edge to the cap and never lets the short edge vanish."""
    longest = F.greatest(width, height)
    shortest = F.least(width, height)
    fit = F.least(F.lit(float(max_px)) / F.when(longest == 0, F.lit(1.0)).otherwise(longest), F.lit(MAX_ZOOM))
    floor = F.greatest(fit, F.lit(1.0) / F.greatest(shortest, F.lit(0.01)))
    return F.when(shortest * fit < 1, floor).otherwise(fit)


def page_tiles(width: Column, height: Column, max_px: int = MAX_PAGE_PX) -> Column:
    """Billing tiles of the scaled image."""
    zoom = page_zoom(width, height, max_px)
    return (F.ceil(width * zoom / TILE_PX) * F.ceil(height * zoom / TILE_PX)).cast("bigint")
