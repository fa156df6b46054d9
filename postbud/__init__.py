"""Periodic registry deliveries as Spark jobs: conform, number, enrich, publish."""

from postbud.options import DeliveryOptions

__all__ = ["DeliveryOptions"]
