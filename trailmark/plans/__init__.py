"""Query registry: what the driver can run."""
