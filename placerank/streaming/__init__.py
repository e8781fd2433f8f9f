"""Event stream."""
