"""Landing-zone readers and writers."""
