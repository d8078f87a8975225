"""Text forms of the results."""
