"""martflow.plans."""
