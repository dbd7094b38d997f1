"""Column builders. Each takes and returns Columns; none runs a job."""
