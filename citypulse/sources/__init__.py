"""Sources and sinks: CSV / Parquet scans, artifact sinks, metrics, model store,
and adapters that map the driver's tables onto the incident contract."""

from citypulse.sources.files import (  # noqa: F401
    scan_incidents_csv, read_through_parquet, scan_parquet, write_parquet_artifacts,
    write_metrics_json, read_metrics_json, save_model, load_model,
)
