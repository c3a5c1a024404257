"""sourcefold: curation of facts from many sources, as Spark jobs over tables."""
