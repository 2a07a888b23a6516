"""Readers and parsers. Each text source is split in two: ``read_*`` turns
files into a DataFrame of lines (or raw rows), ``parse_*`` turns lines into
typed columns. Parsing never raises on a dirty line: unparseable fields
become null and the row is dropped or defaulted as the source's rule says."""
