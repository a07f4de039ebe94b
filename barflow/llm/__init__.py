"""Training-data operators: filtering, deduplication, scoring, token counts and web archives."""
