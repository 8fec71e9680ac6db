"""Column-level building blocks: pure expressions, no joins and no actions."""
