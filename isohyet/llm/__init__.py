"""Training-data operators: tokenising, deduplication, filtering, scoring, archiving, formatting."""
