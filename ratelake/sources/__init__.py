"""Sources: landed files, archives, tables and topics as DataFrames."""
