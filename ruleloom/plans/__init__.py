"""ruleloom.plans."""
