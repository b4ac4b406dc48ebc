"""Reading and publishing stored tables."""
