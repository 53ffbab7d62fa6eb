"""The fourteen marts. Every function takes tables and returns a DataFrame."""
