"""Sources and sinks: landing documents, raw tables, generated spines, and writes."""
