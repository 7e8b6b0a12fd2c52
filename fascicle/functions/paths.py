"""File-name parsing for paged documents and their side files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnOrName, col


def file_name(path: ColumnOrName) -> Column:
    return F.regexp_extract(col(path), r"([^/]*)$", 1)


def extension(path: ColumnOrName) -> Column:
    """Text after the last dot of the file name, without the dot; empty when there is none."""
    return F.regexp_extract(col(path), r"\.([^./]*)$", 1)


def base_name(path: ColumnOrName) -> Column:
    """The path without its last extension."""
    return F.regexp_replace(col(path), r"\.[^./]*$", "")


def doc_root(path: ColumnOrName, ext: str = ".pdf") -> Column:
    """The whole document a page file belongs to: text before ``_page_`` plus ``ext``."""
    return F.concat(F.split_part(base_name(path), F.lit("_page_"), F.lit(1)), F.lit(ext))


def page_name(root: ColumnOrName, page: ColumnOrName, ext: str = ".pdf") -> Column:
    """Page file name with the page number padded to four digits."""
    return F.concat(col(root), F.lit("_page_"), F.lpad(col(page).cast("string"), 4, "0"), F.lit(ext))


def image_number(path: ColumnOrName, ext: str = "jpeg") -> Column:
    """The number in ``<base>-img-<number>.<ext>``; NULL for other names."""
    return F.regexp_extract(col(path), rf"-img-([0-9]+)\.{ext}$", 1).try_cast("int")


def has_extension(path: ColumnOrName, ext: str) -> Column:
    return F.lower(col(path)).endswith(ext.lower())
