"""End-to-end jobs (JOB) and the registered queries."""
