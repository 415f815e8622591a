"""Reports and audits: operators put together."""
