"""ruleloom.streaming."""
