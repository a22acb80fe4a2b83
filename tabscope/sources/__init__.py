"""Reading tables: CSV with typed columns, date detection, file manifests."""
