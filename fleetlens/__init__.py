"""Ride-event analytics on Spark: windows, joins, detection and ranked reads."""
