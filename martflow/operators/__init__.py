"""martflow.operators."""
