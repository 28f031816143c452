"""End-to-end table builds (domain jobs) and the queries run on the driver test tables."""
