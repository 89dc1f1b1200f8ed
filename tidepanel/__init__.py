"""Calendar-aware price-panel analytics on Spark."""
