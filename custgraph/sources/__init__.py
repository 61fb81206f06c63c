"""Readers and writers: CSV node tables, graph scans, document files, the enrichment log."""
