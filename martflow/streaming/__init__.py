"""martflow.streaming."""
