"""folio — document analytics on Spark.

Turns decoded document tables (files, page text, positioned words, ruling
edges, OCR lines, pixels) into clean page records, tables, layouts and text
regions.  Every operator takes and returns DataFrames; nothing is collected
to the driver.
"""

__version__ = "0.1.0"
