"""Sources and sinks: raw recording files, processed tables, reports."""
