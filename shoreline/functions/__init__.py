"""Column-level functions: time normalisation, value conversion, text
preparation, vector distances and the offline hashed embedding."""
