"""DataFrame -> DataFrame operators, keyed by meter or entity."""
