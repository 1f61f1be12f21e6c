"""Sources and sinks: text lines, typed TSV, key lists, driver-table inputs."""
