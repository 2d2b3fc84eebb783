"""Column functions: text in, text out, no jobs."""
