"""ruleloom.functions."""
