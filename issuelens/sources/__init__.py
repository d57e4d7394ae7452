"""Sources (landed pages) and sinks (CSV, run summary)."""
