"""Keeping the mart current from a stream of telemetry."""
