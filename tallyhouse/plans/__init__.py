"""The warehouse itself: dimensions, facts, rollups, marts, report sets and checks."""
