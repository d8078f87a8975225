"""Text records and side lists."""
