"""Sources and sinks of sequencing formats."""
