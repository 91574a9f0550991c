"""Operator 11: fill-in-middle transformation by rank and select over packed boundary bits.

Units are runs of A-Z and a-z, or one other code point. The texts of a batch become one row of bits, a one wherever a unit
starts. Ones between a text's ends are its n; select on the two drawn ranks gives the byte cuts; code points before a cut
are a rank on the bits of first bytes. Only the cuts leave Python: Spark cuts, joins and digests the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import common

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100: from here a text stays as it is; below this the suffix comes first.
PLAIN_FROM, SPM_BELOW = 90, 20
#: Bytes of texts in one bit row; a longer text has a row of its own.
ROW_BYTES = 4_000_000
_CUTS = StructType([StructField("n", LongType()), *[StructField(x, LongType()) for x in ("prefix_bytes", "middle_bytes", "prefix_chars", "middle_chars")]])


def cuts(texts: pa.Array, draws: np.ndarray) -> list[np.ndarray]:
    """n, bytes of prefix and middle, code points of prefix and middle for each text. draws: two numbers for each text."""
    from .rankselect import BitRow, starts

    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    out = [np.zeros(len(texts), dtype=np.int64) for _ in range(5)]
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + ROW_BYTES, side="right")) - 1)
        own = offsets[at : to + 1] - offsets[at]
        part = data[offsets[at] : offsets[to]]
        units, chars = BitRow(starts(part, own)), BitRow((part & 0xC0) != 0x80)
        before = units.rank(own)
        n = np.diff(before)
        drawn = np.sort(draws[at:to] % (n + 1)[:, None], axis=1)
        # a cut after k units is where unit k starts; after the last unit it is the text's end
        first, second = (np.where(k < n, units.select(before[:-1] + k), own[1:]) for k in drawn.T)
        first_chars, second_chars = chars.rank(first), chars.rank(second)
        for column, values in zip(out, (n, first - own[:-1], second - first, first_chars - chars.rank(own[:-1]), second_chars - first_chars)):
            column[at:to] = values
        at = to
    return out


def _cut_column():
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        from ledgerloom.llm import op11_fill_middle as own

        for texts, a, b in batches:
            draws = np.stack([x.to_numpy(zero_copy_only=False) for x in (a, b)], axis=1)
            yield pa.StructArray.from_arrays([pa.array(x) for x in own.cuts(texts, draws)], ["n", "prefix_bytes", "middle_bytes", "prefix_chars", "middle_chars"])

    # the worker looks these types up by name
    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, _CUTS)


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of 8 hexadecimal digits (from 1) as a number."""
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each row; other columns are not read.

    What is drawn depends on the id alone: equal ids with equal texts give equal rows. A null text is empty, a null id is
    drawn as one without digits. Empty texts and those that hold a mark are plain; plain rows have null cuts.
    """
    common.prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), common.text_of(text_col).alias("text"))
    rows = rows.withColumn("h", F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256))
    rows = rows.select("doc_id", "text", *[_draw(F.col("h"), k).alias(f"h{k}") for k in (1, 2, 3, 4)])
    rows = rows.withColumn("c", _cut_column()("text", "h1", "h2"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    form = F.when((F.col("text") == "") | marked | (F.col("h3") % 100 >= PLAIN_FROM), "plain").when(F.col("h4") % 100 < SPM_BELOW, "spm").otherwise("psm")
    data, first, middle = F.col("text").cast("binary"), F.col("c.prefix_bytes").cast("int"), F.col("c.middle_bytes").cast("int")
    piece = lambda start, size: F.substring(data, start, size).cast("string")
    prefix, inner, rest = piece(F.lit(1), first), piece(first + 1, middle), piece(first + middle + 1, F.octet_length(data))
    mark = F.lit
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(mark(PREFIX), prefix, mark(SUFFIX), rest, mark(MIDDLE), inner))
        .otherwise(F.concat(mark(SUFFIX), rest, mark(PREFIX), prefix, mark(MIDDLE), inner))
    )
    unless_plain = lambda c: F.when(F.col("form") != "plain", F.col(f"c.{c}")).alias(c)
    return rows.withColumn("form", form).select("doc_id", F.col("c.n").alias("n"), "form", unless_plain("prefix_chars"), unless_plain("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, from output and form alone. A text with marks is plain, so each mark stands once."""
    between = lambda a, b: F.substring_index(F.substring_index(output, b, 1), a, -1)
    last = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), last, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), last, between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(common.table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


OP11_SQL = """
WITH h AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM h),
c AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m, coalesce(array_to_string(units[b + 1:n], ''), '') AS s FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(output) AS output_sha256, sha256(text) AS restored_sha256
FROM o
"""
