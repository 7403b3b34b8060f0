"""Landing readers and artifact writers."""
