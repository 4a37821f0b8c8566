"""End-to-end loads and syncs."""
