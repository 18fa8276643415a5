"""Column expressions shared by batch and streaming plans (built-in functions only)."""
