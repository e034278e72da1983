"""Sources and sinks: landing CSV drops, layer Parquet tables, the audit table, and the adapter that
maps the driver's TPC-H-style tables onto the nine raw (all-string) landing frames."""
