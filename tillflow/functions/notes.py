"""Links between bills that the till writes into the free-text note of a log row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases of the till's notes.
MERGE_TAG = "[Gộp đơn]"
SPLIT_TAG = "[Tách đơn]"
MERGED_INTO = "hóa đơn bị hủy bởi vì gộp vào"
BECAME = "tạo thành hóa đơn"
SPLIT_OFF = "các món được tách và tạo thành hóa đơn"
NEWLY_MADE = "hóa đơn được tạo mới"


def _says(note: Column, phrase: str) -> Column:
    """Contains, in any letter case, accented letters included; a missing note says nothing."""
    return F.coalesce(F.contains(F.lower(note), F.lit(phrase.lower())), F.lit(False))


def id_after(note: Column, phrase: str) -> Column:
    """The bill id that follows ``phrase``: up to `` -``, else its leading capitals and digits."""
    up_to_dash = F.regexp_extract(note, "(?U)" + phrase + r"\s+(.+?)\s+-", 1)
    leading = F.regexp_extract(note, "(?U)" + phrase + r"\s+([A-Z0-9]+)", 1)
    found = F.when(up_to_dash != "", up_to_dash).when(leading != "", leading)
    return F.nullif(F.trim(found), F.lit(""))


def merged_into(note: Column) -> Column:
    return id_after(note, MERGED_INTO)


def split_into(note: Column) -> Column:
    return F.when(_says(note, SPLIT_TAG) & _says(note, SPLIT_OFF), id_after(note, BECAME))


def is_merge_note(note: Column) -> Column:
    return F.coalesce(F.contains(note, F.lit(MERGE_TAG)), F.lit(False))


def is_new_bill_note(note: Column) -> Column:
    return _says(note, NEWLY_MADE)
