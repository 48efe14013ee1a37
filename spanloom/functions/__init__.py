"""Part of spanloom."""
