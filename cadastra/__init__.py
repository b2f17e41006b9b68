"""Building-registry analytics as Spark jobs: ingest, clean, profile, analyse, load."""
