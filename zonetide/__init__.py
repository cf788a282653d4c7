"""zonetide: trip, weather and change-stream analytics as plain Spark DataFrame functions."""
