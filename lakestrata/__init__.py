"""Layered analytical tables on Spark: land, keep the latest, decode, enrich, publish."""
