"""What the training-data operators share: tables, words and the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vistaframe.sources.tables import Scratch, shared_dir, ship, table, written

__all__ = ["WORD", "Scratch", "held_out", "shared_dir", "ship", "table", "word_count", "written"]

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text as WORD defines them; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold that no label may be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
