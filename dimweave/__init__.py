"""Dimensional loads (slowly changing dimensions, windowed fact merge, rejects) on Spark."""
