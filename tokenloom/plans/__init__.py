"""Jobs over files, registered queries and their SQL."""
