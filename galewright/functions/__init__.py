"""Column-level building blocks: rule tables, hashing, numeric helpers, metric templates."""
