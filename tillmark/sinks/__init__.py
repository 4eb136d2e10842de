"""Where frames go: Parquet folders, catalog tables, databases over JDBC and report files."""
