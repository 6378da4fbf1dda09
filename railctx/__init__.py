"""Railway stops joined with station and weather context, as Spark batch jobs."""
