"""Reading extracts, keeping tables, and shared scratch space."""
