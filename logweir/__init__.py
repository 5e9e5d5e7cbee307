"""Turn raw nested logs into typed, query-ready tables with Spark, and keep them healthy day by day."""
