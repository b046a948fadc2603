"""Words that several tests use."""

STOP = ["the", "and", "are", "two"]
