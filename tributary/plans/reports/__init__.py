"""The business reports. Each is a function of its input tables and parameters."""
