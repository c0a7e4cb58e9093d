"""Listing rules of the three jobs, applied to any file listing DataFrame
(file_path, ...): the Python data source in `darkroom.sources.media_files`,
a landed inventory table, or a fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame

from darkroom.constants import BACKUP_EXCLUDE_DIRS, METADATA_EXCLUDE_DIRS
from darkroom.functions.names import base_name, has_excluded_component, is_image_any_case, is_image_exact_case


def metadata_listing(listing: DataFrame, excluded: tuple[str, ...] = METADATA_EXCLUDE_DIRS) -> DataFrame:
    """Files the metadata job considers: name ends with an image suffix in all
    lower or all upper case, and no path component is excluded ('library'
    included: the photo server's own folders are skipped)."""
    return listing.where(is_image_exact_case(base_name("file_path")) & ~has_excluded_component("file_path", excluded))


def backup_listing(listing: DataFrame, excluded: tuple[str, ...] = BACKUP_EXCLUDE_DIRS) -> DataFrame:
    """Files the backup considers: image suffix in any case; 'library' kept."""
    return listing.where(is_image_any_case(base_name("file_path")) & ~has_excluded_component("file_path", excluded))
