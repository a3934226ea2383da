"""Call-centre reports as Spark DataFrame jobs."""
