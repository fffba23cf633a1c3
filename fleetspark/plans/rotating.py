"""Predicted trips of a fleet with rotating ids."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetspark.operators.rotating import DestinationModel, as_trips, rental_destinations


def rotating_trips(
    sightings: DataFrame, locations: DataFrame, model: DestinationModel, networks: dict | None = None,
    roles: str = "literal", metres: str = "sphere",
) -> DataFrame:
    """Pairs, plausible candidates, the predicted destination, and the trip layout."""
    return as_trips(rental_destinations(sightings, model, roles, metres), locations, networks)
