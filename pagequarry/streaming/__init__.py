"""Work on pages as they arrive."""
