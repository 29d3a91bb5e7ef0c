"""fieldtally: running counts over organism-sighting records, as Spark jobs."""
