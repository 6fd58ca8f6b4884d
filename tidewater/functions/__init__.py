"""Column-level building blocks: envelope, positions, payload codecs and schemas."""
