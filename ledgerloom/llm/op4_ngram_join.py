"""Operator 4: similarity join of documents by Jaccard of their word shingles, with Bayesian pruning of candidates.

1. One pass gives each document its shingle set's digest (equal sets are one node), MinHash values and band keys.
2. Nodes that share a band key meet in groups; large groups are cut into pairs of blocks. There MinHash values are
   compared step by step, and a pair is dropped once its posterior chance of reaching the threshold is below tolerance.
   Of the survivors only a spanning set of edges leaves the task.
3. Components of these edges gather what has to be verified. Their texts' shingle sets, cut into pairs of blocks again,
   are intersected exactly; each node gets the number of documents that it links to, and spanning edges of true links.
4. Components of the true links are the classes.
Nothing is emitted for each pair, and copies stay linear in rows; a large group of different near copies of m nodes is sent
as m * m / BLOCK rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .graph import components

SHINGLE, THRESHOLD = 5, 0.8
#: A candidate is dropped once its posterior chance of reaching the threshold is below this.
TOLERANCE = 1e-5
#: Nodes of a block: larger groups are compared block against block.
BLOCK = 1024


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, node, n, keys, sig): node is null for a text without words."""

    def run(batches):
        from ledgerloom.llm import shingles as s

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [s.shingle_set(t, size) for t in part.column(1).to_pylist()]
                full = [i for i, x in enumerate(sets) if len(x)]
                node, keys, sig = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    values = s.signatures([sets[i] for i in full])
                    for i, k, v in zip(full, s.bands(values).tolist(), s.short(values)):
                        node[i], keys[i], sig[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), k, v.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(node, pa.binary()), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    ["id", "node", "n", "keys", "sig"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, node binary, n long, keys array<long>, sig binary")


def _block_pairs(rows: DataFrame, key: str, members: Column) -> DataFrame:
    """Each row once for every pair of blocks it is part of: columns a and b, and own, its block."""
    n = F.ceil(members / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("node"), n).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda y: F.struct(F.least(own, y).alias("a"), F.greatest(own, y).alias("b")))
    out = rows.select("*", own.alias("own"), F.explode(pairs).alias("p")).select("*", "p.a", "p.b").drop("p")
    return out.repartition(key, "a", "b").sortWithinPartitions(key, "a", "b")


def _groups(batches, columns: list[str], least_rows: int):
    """Whole groups of rows with equal key, a and b, several at a time: lists of columns, and where each group begins."""
    held, n = [], 0

    def cut(rows: pa.Table):
        keys = rows.select(columns[:3]).combine_chunks()
        new = np.zeros(rows.num_rows, dtype=bool)
        for c in keys.columns:
            x = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
            if pa.types.is_binary(x.type):
                x = np.array(x.to_pylist(), dtype=object)
            else:
                x = x.to_numpy(zero_copy_only=False)
            new[1:] |= x[1:] != x[:-1]
        return np.append(0, np.flatnonzero(new))

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= least_rows:
            rows = pa.Table.from_batches(held)
            starts = cut(rows)
            if len(starts) > 1:
                yield rows.slice(0, int(starts[-1])), starts[:-1]
                rows = rows.slice(int(starts[-1])).combine_chunks()
            held, n = rows.to_batches(), rows.num_rows
    if n:
        rows = pa.Table.from_batches(held)
        yield rows, cut(rows)


def _pairs(starts: np.ndarray, sizes: np.ndarray, own: np.ndarray, apart: np.ndarray):
    """Rows i and j of all pairs within each group, groups of one size together; with `apart`, of different blocks only."""
    for m in np.unique(sizes[sizes > 1]):
        some = np.flatnonzero(sizes == m)
        a, b = np.triu_indices(int(m), 1)
        step = max(1, 500_000 // len(a))
        for at in range(0, len(some), step):
            g = some[at : at + step]
            i, j = (starts[g][:, None] + a).ravel(), (starts[g][:, None] + b).ravel()
            ok = ~np.repeat(apart[g], len(a)) | (own[i] != own[j])
            yield i[ok], j[ok]


def _candidates(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(u, v): edges that span what survives within each group."""

    def run(batches):
        from ledgerloom.llm import op4_ngram_join as own_module
        from ledgerloom.llm import shingles as s

        for rows, starts in own_module._groups(batches, ["key", "a", "b"], 20_000):
            sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(rows.num_rows, s.HASHES)
            own, sizes = rows.column("own").to_numpy(), np.diff(np.append(starts, rows.num_rows))
            apart = (rows.column("a").to_numpy() != rows.column("b").to_numpy())[starts]
            kept = [(i[k], j[k]) for i, j in own_module._pairs(starts, sizes, own, apart) if len(k := s.survivors(sig, i, j, threshold, tolerance))]
            if kept:
                root = s.roots(rows.num_rows, *(np.concatenate(x) for x in zip(*kept)))
                below = np.flatnonzero(root != np.arange(len(root)))
                node = rows.column("node").combine_chunks()
                edges = pa.table([node.take(pa.array(below)), node.take(pa.array(root[below]))], ["u", "v"])
                yield from edges.group_by(["u", "v"]).aggregate([]).to_batches()

    return members.select("key", "a", "b", "own", "node", "sig").mapInArrow(run, "u binary, v binary")


def _verified(rows: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(node, links, root): documents of other nodes that a node links to, and a node that true links lead to."""

    def run(batches):
        from ledgerloom.llm import op4_ngram_join as own_module
        from ledgerloom.llm import shingles as s

        for rows, starts in own_module._groups(batches, ["comp", "a", "b"], 2000):
            sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(rows.num_rows, s.HASHES)
            own, weight = rows.column("own").to_numpy(), rows.column("weight").to_numpy()
            apart = rows.column("a").to_numpy() != rows.column("b").to_numpy()
            sets = [np.frombuffer(x, "<u8") for x in rows.column("set").to_pylist()]
            n = np.array([len(x) for x in sets])
            links, root = np.zeros(rows.num_rows, dtype=np.int64), np.arange(rows.num_rows)
            for at, end in zip(starts, np.append(starts[1:], rows.num_rows)):
                found = [(i[k], j[k]) for i, j in own_module._pairs(np.array([0]), np.array([end - at]), own[at:end], apart[at : at + 1]) if len(k := s.survivors(sig[at:end], i, j, threshold, tolerance))]
                if not found:
                    continue
                i, j = (np.concatenate(x) for x in zip(*found))
                both = s.intersections(sets[at:end])[i, j]
                ok = both >= threshold * (n[at + i] + n[at + j] - both) - 1e-9
                i, j = i[ok], j[ok]
                links[at:end] += np.bincount(i, weight[at + j], end - at).astype(np.int64) + np.bincount(j, weight[at + i], end - at).astype(np.int64)
                root[at:end] = at + s.roots(end - at, i, j)
            node = rows.column("node").combine_chunks()
            yield from pa.table([node, pa.array(links), node.take(pa.array(root))], ["node", "links", "root"]).to_batches()

    return rows.select("comp", "a", "b", "own", "node", "weight", "sig", "set").mapInArrow(run, "node binary, links long, root binary")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(id, class_id, n_links, n_copies, n_shingles) of every document row.

    Two documents are linked if the Jaccard of their distinct shingles (`size` words, A-Z lower-cased, between white
    space; a text of fewer words is one shingle) is at least `threshold`. class_id is the lowest id of all documents
    that links lead to; n_links counts linked documents, n_copies those of them with the same shingles. Texts without
    words, null ones too, link to nothing and are their own class. Rows with a null id get a null class and link to
    nothing; rows with equal ids are documents of their own. Other columns are not read. No rows give no rows.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    all_rows = common.persist(sketches(docs, id_col, text_col, size), "sketches")
    known = all_rows.where("node is not null and id is not null")
    grouped = known.groupBy("node").agg(F.count("*").alias("weight"), F.min("id").alias("first_id"), F.min(F.struct("id", "keys", "sig")).alias("x"))
    nodes = common.persist(grouped.select("node", "weight", "first_id", "x.keys", "x.sig"), "nodes")

    keyed = nodes.select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = keyed.join(shared, "key").join(nodes.select("node", "sig"), "node")
    edges = _candidates(_block_pairs(members, "key", F.col("members")), threshold, tolerance)
    near = common.persist(components(edges), "candidates")

    sizes = near.groupBy("label").agg(F.count("*").alias("members"))
    to_verify = near.join(sizes, "label").join(nodes.drop("keys"), "node")
    to_verify = common.persist(to_verify.select(F.col("label").alias("comp"), "members", "node", "weight", "first_id", "sig"), "to-verify")

    def sets(batches):
        from ledgerloom.llm import shingles as s

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                own = [s.shingle_set(t, size).astype("<u8").tobytes() for t in batch.slice(at, 200).column(0).to_pylist()]
                digest = [hashlib.blake2b(x, digest_size=16).digest() for x in own]
                yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(own, pa.binary())], ["node", "set"])

    wanted = to_verify.select(F.col("first_id").alias(id_col)).distinct().hint("shuffle_hash")
    texts = docs.select(id_col, text_col).join(wanted, id_col, "left_semi").select(text_col)
    sets_ = texts.mapInArrow(sets, "node binary, set binary").dropDuplicates(["node"])
    rows = to_verify.join(sets_, "node")
    checked = common.persist(_verified(_block_pairs(rows, "comp", F.col("members")), threshold, tolerance), "links")

    true = components(checked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    label = nodes.select("node", "weight", "first_id").join(true, "node", "left").join(links, "node", "left")
    label = common.persist(label.select("node", "weight", "first_id", F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).alias("links")), "labels")
    lowest = label.groupBy("label").agg(F.min("first_id").alias("class_id"))
    info = label.join(lowest, "label").select("node", "class_id", "links", "weight")
    out = all_rows.select("id", F.when(F.col("id").isNotNull(), F.col("node")).alias("node"), "n").join(info, "node", "left")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("weight") - 1, F.lit(0)).cast("long").alias("n_copies"), F.col("n").alias("n_shingles"),
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(common.table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of rows, the one with the lowest doc_id stays, null ids last; of equal ids the first row written.

    Rows are told apart by a key written with them, so repeated and null ids are documents like all others.
    """
    docs, columns = common.with_key(docs), docs.columns
    linked = classes(docs, common.KEY).where("n_links > 0").select(common.KEY, "class_id")
    ranked = linked.join(docs.select(common.KEY, "doc_id").hint("shuffle_hash"), common.KEY)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", common.KEY)).alias("first")
    kept = ranked.groupBy("class_id").agg(first).select(f"first.{common.KEY}")
    dropped = linked.select(common.KEY).join(kept.hint("shuffle_hash"), common.KEY, "left_anti")
    return docs.join(dropped.hint("shuffle_hash"), common.KEY, "left_anti").select(*columns)
