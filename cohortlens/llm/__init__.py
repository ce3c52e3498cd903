"""Training-data operators: decontamination, classifiers, deduplication,
packing, token files, web archives and text extraction, as Spark jobs.

Nothing outside this package imports it."""
