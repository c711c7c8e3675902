"""Stage 1 over files as they arrive."""
