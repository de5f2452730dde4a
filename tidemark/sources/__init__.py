"""File readers: CSV/TSV as text, headerless report matrices, header
detection, encoding detection, landed workbook sheets, JSON documents and
file listings."""
