"""Sources and sinks: files, message topics, JDBC tables, document stores."""
