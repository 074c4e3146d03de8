"""Sources: test tables, 2D value grids and file trees."""
