"""Tile grid of a country."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scarmap.operators import tiles as T


def build_tile_grid(country: DataFrame, keys: list[str], zoom: int, clip: bool = True) -> DataFrame:
    """Tiles that meet the country, their share of area in it and, with ``clip``, their cut geometry."""
    return T.tile_grid(country, keys, zoom, clip)
