"""Column-level building blocks: calendar, fixed lookups and the rating rules."""
