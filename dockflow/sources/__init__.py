"""Sources and sinks: raw CSV zone, ZIP archives, curated Parquet zone, result export, test fixture."""
