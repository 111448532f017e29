"""ratelake: health-insurance price transparency data as Spark tables and jobs."""
