"""Where frames come from: raw files, layers of the lake, catalog tables and message logs."""
