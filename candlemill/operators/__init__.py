"""Pure ``DataFrame -> DataFrame`` transforms. None of them reads, writes or collects."""
