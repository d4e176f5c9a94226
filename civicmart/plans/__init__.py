"""Stages of the zone flow, and the queries over the star-schema tables."""
