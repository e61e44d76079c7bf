"""Sources: driver tables, stand-in datasets, landed files and streams."""
