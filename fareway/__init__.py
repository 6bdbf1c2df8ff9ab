"""Ride-hailing analytics as Spark DataFrame operators and jobs."""
