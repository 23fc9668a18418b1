"""Sources: workbook folders and the catalog."""
