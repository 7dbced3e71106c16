"""Registered queries: importing the package fills catalogue.QUERIES and catalogue.ORACLES."""

from geokernel.plans import catalogue, columns, control, imagery, radiometry, streams, surfaces, texture

__all__ = ["catalogue", "columns", "control", "imagery", "radiometry", "streams", "surfaces", "texture"]
