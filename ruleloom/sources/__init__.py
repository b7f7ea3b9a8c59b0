"""ruleloom.sources."""
