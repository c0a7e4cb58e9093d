"""Fixed values that must equal the photo-server scripts' values for equal
results. Kept together, as plain text, in the scripts' own order."""

# --- fixed values -----------------------------------------------------------
# Image suffixes (lower case) recognised by the metadata and backup listings.
IMAGE_EXTENSIONS = (
    ".jpg", ".jpeg", ".raw", ".cr2", ".nef", ".arw", ".dng", ".tif", ".tiff", ".png", ".raf",
)
# Path components skipped by the metadata listing.
METADATA_EXCLUDE_DIRS = ("library", "thumbs", "encoded-video", "profiles", "backups")
# Path components skipped by the backup listing ('library' is kept on purpose).
BACKUP_EXCLUDE_DIRS = ("thumbs", "encoded-video", "profiles", "backups")
# Source tags of the three backup roots, in processing order.
SOURCE_TYPES = ("internal", "external", "immich_upload")
# Ledger status values.
STATUS_UPLOADED = "uploaded"
STATUS_ERROR = "error"
# Library type that the external-only scan skips; also the default type.
LIBRARY_UPLOAD = "UPLOAD"
LIBRARY_DEFAULT_NAME = "Unnamed"
# Metadata batch size and card-import free-space threshold (GB).
DEFAULT_BATCH_SIZE = 50
MIN_FREE_SPACE_GB = 10
# Asset page size of the photo-server search API.
ASSET_PAGE_SIZE = 1000
# EXIF field chains: the first truthy candidate wins, the last is kept as is.
DATE_CHAIN = ("DateTimeOriginal", "CreateDate")
LENS_CHAIN = ("Lens", "LensModel", "LensID")
SHUTTER_CHAIN = ("ShutterSpeed", "ExposureTime", "ShutterSpeedValue")
ISO_CHAIN = ("ISO", "ISOValue")
APERTURE_CHAIN = ("FNumber", "ApertureValue")
# EXIF date text format (strptime spelling).
EXIF_DATE_FORMAT = "%Y:%m:%d %H:%M:%S"
# Default for absent keys in the one-file report.
REPORT_MISSING = "N/A"
# --- end of fixed values ----------------------------------------------------
