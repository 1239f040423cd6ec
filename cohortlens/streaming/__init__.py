from cohortlens.streaming.ingest import start_ingest, stream_mapping, stream_source  # noqa: F401
