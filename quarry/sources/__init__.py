"""Reading: catalog look-ups, table extract, column metadata, file helpers."""
