from stratus.streaming.corrections import ingest_corrections, newest_versions  # noqa: F401
from stratus.streaming.ingest import ingest_available, land, replace_batch  # noqa: F401
