"""Reading sources and writing exports and their records."""
