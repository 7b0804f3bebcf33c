"""Sources: landed documents, dimension files, seeds and the generated test tables."""
