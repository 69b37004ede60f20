"""The operators applied to the driver's tables."""
