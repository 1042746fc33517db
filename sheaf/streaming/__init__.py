"""Harvesting what lands, as it lands."""
