"""Customer-attrition analytics written as Spark DataFrame jobs."""
