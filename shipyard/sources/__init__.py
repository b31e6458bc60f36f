"""Raw feed listing and scans, bronze ingest, reference dimensions."""
