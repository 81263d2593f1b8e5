"""Column builders; none of them runs a job."""
