"""Point-in-time risk analytics as Spark plans."""
