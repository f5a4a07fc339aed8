"""The two monthly feeds, composed from the operators."""
