"""Reports, checks, monitoring and the load job, composed from operators."""
