"""Web-request analytics on Spark: access logs to silver, star schema and summaries."""
