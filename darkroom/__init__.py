"""darkroom: media-library data work (photo catalogue, backup ledger, card
import, RAW+JPEG stacking) expressed as Spark DataFrame jobs.

Every public operator takes DataFrames and returns DataFrames; nothing is
collected to the driver. See README.md for the operator map.
"""

__version__ = "0.1.0"
