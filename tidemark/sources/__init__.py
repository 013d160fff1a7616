"""Sources and sinks: landing files, manifest, CSV, synthetic fixture, driver-table mapping."""
