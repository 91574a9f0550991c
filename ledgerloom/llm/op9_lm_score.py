"""Operator 9: language-model scores of all documents from a backoff automaton of the corpus's own n-grams.

Documents are tokenised once into blocks of bounded size, a written table. Each block sends the distinct n-grams it
holds, with its training counts, to ranges of hashes; a range adds them up over all blocks, in levels of bounded fan-out,
and answers each block with the corpus's counts for exactly the n-grams it asked for. A block then builds its part of the
automaton, numbered states with arcs and failure arcs, and reads its own documents from left to right. A frequent n-gram
comes once from each block, so no range is hot; no table of all n-grams exists anywhere.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .backoff import Grams

ORDER = 3
#: Weight of the shorter history, in observations.
MU = 100.0
BLOCK_TOKENS = 1_200_000
#: n-grams that a range of hashes gets from all units that meet in a task, about, and such units.
RANGE_GRAMS, FAN = 1_000_000, 256
#: Documents whose crc32 of the id modulo this is HELD_OUT are not learned from.
FOLDS, HELD_OUT = 7, 2


def packed(x: np.ndarray, kind: str = "<u8") -> bytes:
    """Whole numbers with their lowest bytes first, then the second ones, and so on, compressed: high ones are mostly zero."""
    planes = np.ascontiguousarray(x.astype(kind).view(np.uint8).reshape(len(x), -1 if len(x) else 1).T).tobytes()
    return len(planes).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpacked(data: bytes, kind: str = "<u8") -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], n, "zstd", asbytes=True) if n else b""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n // width).T).view(kind).ravel()


def packed_hashes(hashes: np.ndarray, cut: int = 0) -> bytes:
    """Sorted hashes by the gaps between them, without their lowest `cut` bits, which are 0."""
    return packed(np.diff(hashes >> np.uint64(cut), prepend=np.uint64(0)))


def unpacked_hashes(data: bytes, cut: int = 0) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64) << np.uint64(cut)


def tokenised(docs: DataFrame, id_col: str, text_col: str, held_out, block_tokens: int) -> DataFrame:
    """Blocks of documents: ids, which train, words and end of each as numbers of the block's own vocabulary."""
    common.prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["block", "ids", "train", "sizes", "tokens", "words"]

    def run(batches):
        from pyspark import TaskContext

        from ledgerloom.llm import backoff

        part, made = TaskContext.get().partitionId() << 32, 0
        id_type = None

        def fresh():
            return defaultdict(count(1).__next__), [], [], [], [], 0

        number, ids, train, sizes, parts, n = fresh()

        def block():
            words = np.array([backoff.word_hash(w) for w in [backoff.END, *number]], dtype="<u8")
            columns = (
                pa.array([part + made]), pa.array([ids], pa.list_(id_type)), pa.array([train], pa.list_(pa.bool_())),
                pa.array([sizes], pa.list_(pa.int32())), pa.array([packed(np.concatenate(parts), "<u4")], pa.binary()), pa.array([words.tobytes()], pa.binary()),
            )
            return pa.RecordBatch.from_arrays(list(columns), names)

        for batch in batches:
            id_type = batch.column(0).type
            for i, text, out in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                w = (text or "").encode().lower().split()
                parts.append(np.append(np.fromiter(map(number.__getitem__, w), np.int32, len(w)), np.int32(0)))
                ids.append(i), train.append(not out), sizes.append(len(w) + 1)
                n += len(w) + 1
                if n >= block_tokens:
                    yield block()
                    made += 1
                    number, ids, train, sizes, parts, n = fresh()
        if ids:
            yield block()

    rows = docs.select(id_col, text_col, F.coalesce(held_out, F.lit(False)).alias("held_out"))
    return rows.mapInArrow(run, f"block long, ids array<{kind}>, train array<boolean>, sizes array<int>, tokens binary, words binary")


def _grams(row: dict, order: int) -> tuple[Grams, np.ndarray, np.ndarray]:
    sizes = np.asarray(row["sizes"], dtype=np.int64)
    train = np.asarray(row["train"], dtype=bool)
    return Grams(unpacked(row["tokens"], "<u4").view(np.int32), sizes, np.frombuffer(row["words"], "<u8"), order), sizes, train


def _cuts(hashes: np.ndarray, first: int, last: int, ranges: int) -> np.ndarray:
    """Where the sorted hashes of each range from `first` to before `last`, of `ranges` equal ones in all, begin and end."""
    inner = np.array([(b << 64) // ranges for b in range(first + 1, last)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, inner), [len(hashes)]])


def _cut_bits(order: int, tokens: int) -> list[int]:
    """For each order the lowest bits of hashes that aren't sent: none of words' own.

    As many stay as keep the chance that an n-gram shares its hash with any other of the corpus below 2 to the -24.
    """
    return [0] + [max(0, 64 - 24 - (order * tokens).bit_length())] * (order - 1)


def _slices(unit, first: int, last: int, ranges: int, hashes: list, counts: list, bits: list[int]) -> pa.RecordBatch:
    """A row (range, unit, grams, counts) for each range that holds some of the unit's n-grams."""
    cuts = [_cuts(h, first, last, ranges) for h in hashes]
    some = [b for b in range(last - first) if any(c[b] < c[b + 1] for c in cuts)]
    grams = [[packed_hashes(h[c[b] : c[b + 1]], x) for h, c, x in zip(hashes, cuts, bits)] for b in some]
    own = [[packed(n[c[b] : c[b + 1]]) for n, c in zip(counts, cuts)] for b in some]
    columns = pa.array([first + b for b in some], pa.int64()), pa.array([unit] * len(some), pa.int64()), pa.array(grams, pa.list_(pa.binary())), pa.array(own, pa.list_(pa.binary()))
    return pa.RecordBatch.from_arrays(list(columns), ["range", "unit", "grams", "counts"])


SLICES = "range long, unit long, grams array<binary>, counts array<binary>"


def _asked(blocks: DataFrame, order: int, ranges: int, bits: list[int]) -> DataFrame:
    """Slices of the n-grams of each block, with their counts in what trains."""

    def run(batches):
        from ledgerloom.llm import op9_lm_score as own

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                g, sizes, train = own._grams(row, order)
                counts = g.counted(np.repeat(train, sizes))
                g.index = g.whole = None
                hashes = [h >> np.uint64(x) << np.uint64(x) for h, x in zip(g.hash, bits)]
                yield own._slices(row["block"], 0, ranges, ranges, hashes, counts, bits)

    return blocks.select("block", "train", "sizes", "tokens", "words").mapInArrow(run, SLICES)


def _added(rows: pd.DataFrame, bits: list[int]) -> tuple[list, list]:
    """For each order the distinct hashes of all slices, and for each slice where its own are among them and its counts."""
    hashes, places = [], []
    for k, cut in enumerate(bits):
        h = [unpacked_hashes(x[k], cut) for x in rows["grams"]]
        unique, inverse = np.unique(np.concatenate(h), return_inverse=True)
        hashes.append(unique)
        places.append(np.split(inverse, np.cumsum([len(x) for x in h])[:-1]))
    return hashes, places


def _summed(rows: pd.DataFrame, hashes: list, places: list) -> list[np.ndarray]:
    totals = [np.zeros(len(h), dtype=np.int64) for h in hashes]
    for k, t in enumerate(totals):
        for place, x in zip(places[k], rows["counts"]):
            np.add.at(t, place, unpacked(x[k]).astype(np.int64))
    return totals


def _answers(rows: pd.DataFrame, totals: list[np.ndarray], places: list) -> list:
    return [[packed(t[p[j]]) for t, p in zip(totals, places)] for j in range(len(rows))]


def _answered(asked: DataFrame, units: int, bits: list[int], ranges: int, fan: int) -> DataFrame:
    """(unit, range, totals, n_words): what each unit asked for, added up over all units.

    n_words: distinct words with a count in a range, on one answer of it, else 0. Up to `fan` units meet in one task for
    each range. Of more, groups of about `fan` are added up first; their sums, cut into `fan` finer ranges, are the units
    of the next level, and the totals come back the same way. So a unit is cut into a bounded number of slices, and levels
    grow with the logarithm of the units.
    """
    groups = -(-units // fan)
    keyed = asked.withColumn("group", F.pmod(F.xxhash64("unit"), F.lit(groups)).cast("long"))
    out = "unit long, range long, totals array<binary>, n_words long"

    def result(rows, answers, words):
        return pd.DataFrame({"unit": rows["unit"].to_numpy(), "range": rows["range"].to_numpy(), "totals": answers, "n_words": [words] + [0] * (len(rows) - 1)})

    if groups <= 1:

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            from ledgerloom.llm import op9_lm_score as own

            hashes, places = own._added(rows, bits)
            totals = own._summed(rows, hashes, places)
            return result(rows, own._answers(rows, totals, places), int((totals[0] > 0).sum()))

        return keyed.groupBy("range").applyInPandas(add, out)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        from ledgerloom.llm import op9_lm_score as own

        hashes, places = own._added(rows, bits)
        totals, at = own._summed(rows, hashes, places), int(rows["range"].iloc[0])
        return own._slices(int(rows["group"].iloc[0]), at * fan, at * fan + fan, ranges * fan, hashes, totals, bits).to_pandas()

    def back(rows: pd.DataFrame, finer: pd.DataFrame) -> pd.DataFrame:
        from ledgerloom.llm import op9_lm_score as own

        if not len(rows):
            return pd.DataFrame({"unit": [], "range": [], "totals": [], "n_words": []})
        places, finer = own._added(rows, bits)[1], finer.sort_values("range")
        totals = [np.concatenate([own.unpacked(x[k]) for x in finer["totals"]]) for k in range(len(bits))]
        return result(rows, own._answers(rows, totals, places), int(finer["n_words"].sum()))

    merged = common.persist(keyed.groupBy("range", "group").applyInPandas(merge, SLICES), "lm-merged")
    deeper = common.persist(_answered(merged, groups, bits, ranges * fan, fan), "lm-totals")
    deeper = deeper.withColumns({"group": F.col("unit"), "up": F.floor(F.col("range") / fan).cast("long")})
    return keyed.groupBy("range", "group").cogroup(deeper.groupBy("up", "group")).applyInPandas(back, out)


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None, order: int = ORDER, mu: float = MU, block_tokens: int = BLOCK_TOKENS, range_grams: int = RANGE_GRAMS, fan: int = FAN) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document row.

    Tokens are the text's words, A-Z lower-cased, and one end. base_score adds log10 of add-one unigrams, score is the
    automaton's log10 probability. held_out: a boolean column, by default crc32 of the id modulo 7 is 2; null counts as
    false. Null and empty texts hold the end only. Repeated rows count and are scored each time; other columns aren't
    read; no rows give no rows. Words are told apart by 64-bit hashes, n-grams by as many bits as the corpus needs.
    """
    spark = docs.sparkSession
    held_out = (common.fold(id_col, FOLDS) == HELD_OUT) if held_out is None else held_out
    blocks = common.persist(tokenised(docs, id_col, text_col, held_out, block_tokens), "lm-blocks")
    per_block = blocks.select(
        F.size("sizes").alias("docs"), F.expr("aggregate(sizes, 0L, (a, x) -> a + x)").alias("tokens"),
        F.expr("aggregate(zip_with(sizes, train, (s, t) -> if(t, s, 0)), 0L, (a, x) -> a + x)").alias("train_tokens"),
        F.expr("size(filter(train, t -> t))").alias("train_docs"), F.lit(1).alias("blocks"),
    )
    total = per_block.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in per_block.columns]).first()
    ranges = max(16, -(-order * min(total.tokens, total.tokens * fan // max(1, total.blocks)) // range_grams))
    bits = _cut_bits(order, total.tokens)
    answers = common.persist(_answered(_asked(blocks, order, ranges, bits), total.blocks, bits, ranges, fan), "lm-counts")
    n_words = answers.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    n_tokens, n_docs = total.train_tokens, total.train_docs

    def score(block: pd.DataFrame, slices: pd.DataFrame) -> pd.DataFrame:
        from ledgerloom.llm import op9_lm_score as own
        from ledgerloom.llm.backoff import Automaton

        row = block.iloc[0]
        g, sizes, train = own._grams(row, order)
        slices = slices.sort_values("range")
        counts = [np.concatenate([own.unpacked(x[k]) for x in slices["totals"]]).astype(np.int64) for k in range(order)]
        automaton = Automaton(g, counts, n_docs, n_tokens, n_words, mu)
        add = lambda x: np.add.reduceat(x, g.start)
        return pd.DataFrame({
            id_col: row["ids"], "held_out": ~train, "n_tokens": sizes, "n_known": add((counts[0] > 0)[g.index[0]].astype(np.int64)),
            "train_tokens": n_tokens, "base_score": add(automaton.root_weight[g.index[0]]), "score": add(automaton.walk()),
        })

    kind = docs.schema[id_col].dataType.simpleString()
    out = f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(answers.select(F.col("unit").alias("block"), "range", "totals").groupBy("block")).applyInPandas(score, out)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(common.table(spark, sf_dir, "documents"))
