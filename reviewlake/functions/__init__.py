"""Column-level helpers (no jobs of their own)."""
