"""The analyses: each function takes model tables and returns a DataFrame."""
