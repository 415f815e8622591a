"""Web-traffic and change-log analytics as Spark DataFrame jobs."""
