"""Multi-currency sales quality and FX conversion as Spark batch jobs."""
