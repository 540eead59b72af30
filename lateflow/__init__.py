"""Windowed event-time analytics on Spark: an explicit watermark policy with a late side
output (streaming job and equivalent batch replay), versioned tables and health reports.
"""

__version__ = "0.1.0"
