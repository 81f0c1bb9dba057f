"""martflow.sources."""
