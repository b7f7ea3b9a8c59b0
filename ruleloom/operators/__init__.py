"""ruleloom.operators."""
