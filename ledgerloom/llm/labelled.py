"""Labelled rows for fitting: a sample of bounded size, whatever the tables' size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Rows with crc32 of the id as text divisible by this are never fitted on.
FOLDS = 5


def held_out(id_col: str = "doc_id"):
    return F.coalesce(common.fold(id_col, FOLDS) == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, columns: list[str], most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, labels) of at most `most` labelled ids that aren't held out, the first ones by a hash of the id.

    Of repeated labels of an id the highest count; ids whose labels are null are left out. At most `most` small rows are
    broadcast; of repeated document rows of an id one stays, the lowest text, so only the sample's texts are shuffled.
    """
    kept = labels.where(~held_out(id_col)).groupBy(id_col).agg(*[F.max(c).alias(f"label_{c}") for c in columns]).dropna()
    chosen = kept.orderBy(F.xxhash64(id_col), id_col).limit(most)
    own = docs.select(F.col(id_col), F.col(text_col)).join(F.broadcast(chosen), id_col)
    return own.groupBy(id_col).agg(F.min(text_col).alias(text_col), *[F.first(f"label_{c}").alias(f"label_{c}") for c in columns])
