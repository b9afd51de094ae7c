"""The package's operators bound to the driver's tables."""
