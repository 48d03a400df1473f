"""scanlake: the data work of a source-repository security pipeline, as Spark jobs."""
