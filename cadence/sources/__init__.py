"""Reading sources (Parquet / JDBC), windowed extracts, and warehouse sinks."""
