"""End-to-end jobs over the driver's test tables and the query registry."""
