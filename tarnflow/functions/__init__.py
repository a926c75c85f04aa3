"""Part of tarnflow."""
