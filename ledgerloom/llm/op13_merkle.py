"""Operator 13: a Merkle manifest of a dataset, as a trie over the digits of group ranks.

Each row is a leaf; the leaves of a group ascend by id. Ranks come from histograms of the ids' leading digits, summed level by
level from long prefixes to short ones and read back down as the rows before each prefix, so nothing is sorted as a whole.
Rank digits to base 16 name the nodes of a trie: all nodes that share all but their last digit are one run, and a run's
digest is the digest of its nodes' digests. Digests of groups, ordered by name, form the trie above.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Lengths of the id prefixes (of 16 hexadecimal digits) whose histograms form the tree; rows of the longest are ordered in one window.
PREFIXES = (14, 11, 8, 5, 2, 0)
#: From so many different rows of one prefix on, digits of the leaf's digest follow the id: many texts share one id there.
CROWDED = 4096
CROWDED_PREFIXES = (22, 19, 16, 14)
#: Equal rows that one task numbers at a time.
COPIES = 1000
FANOUT_BITS = 4


def leaf_digest(fields: list[Column]) -> Column:
    """Lowercase hex sha256 of the fields: `-` for null, else UTF-8 byte count, `:` and the value."""
    text = lambda c: c.cast("string")
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in fields]), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["digest"]), "")


def _bases(counts: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """(g, p, base): rows of the group before prefix p and within the same prefix of the last length. counts: (g, p, n), p of the first length."""
    shorter = lambda n: F.substring("p", 1, n)
    levels = [counts]
    for n in lengths[1:]:
        levels.append(levels[-1].groupBy("g", shorter(n).alias("p")).agg(F.sum("n").alias("n")))
    base = levels[-1].select("g", "p", F.lit(0).cast("long").alias("base"))
    for level, n in zip(levels[-2::-1], lengths[:0:-1]):
        smaller = Window.partitionBy("g", "parent").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
        own = level.withColumn("parent", shorter(n)).withColumn("before", F.coalesce(F.sum("n").over(smaller), F.lit(0)))
        base = own.join(base.select("g", F.col("p").alias("parent"), "base"), ["g", "parent"]).select("g", "p", (F.col("base") + F.col("before")).alias("base"))
    return base


def _ranked(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, k, digest, id, carried): k counts a group's leaves from 0 by id (null first), then by digest; and the written table below, where equal rows are one with their number m."""
    digits = F.lpad(F.hex(F.col("id").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    keyed = leaves.withColumn("key", F.concat(F.coalesce(digits, F.lit("-" * 16)), "digest"))
    written = common.persist(keyed.groupBy("g", "key").agg(F.count("*").alias("m"), *[F.first(c).alias(c) for c in ("digest", "id", "carried")]), "merkle-once")
    once = written.withColumn("p", F.substring("key", 1, PREFIXES[0]))
    counts = common.persist(once.groupBy("g", "p").agg(F.sum("m").alias("n"), F.count("*").alias("different")), "merkle-counts")
    base = _bases(counts.select("g", "p", "n"), PREFIXES)
    crowded = counts.where(F.col("different") > CROWDED).select("g", "p", F.lit(True).alias("crowded"))
    rows = once.join(crowded, ["g", "p"], "left").withColumn("bucket", F.when(F.col("crowded"), F.substring("key", 1, CROWDED_PREFIXES[0])).otherwise(F.col("p")))
    deeper = _bases(rows.where("crowded").groupBy("g", F.col("bucket").alias("p")).agg(F.sum("m").alias("n")), CROWDED_PREFIXES)
    inner = deeper.withColumn("bucket", F.col("p")).withColumn("p", F.substring("p", 1, PREFIXES[0])).withColumnRenamed("base", "within")
    inner = inner.join(base, ["g", "p"]).select("g", "bucket", (F.col("base") + F.col("within")).alias("base"))
    bases = base.join(crowded, ["g", "p"], "left_anti").select("g", F.col("p").alias("bucket"), "base").unionByName(inner)
    before = Window.partitionBy("g", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))).join(bases, ["g", "bucket"])
    placed = common.persist(placed.select("g", "digest", "id", "carried", "m", (F.col("base") + F.col("before")).alias("k")), "merkle-placed")
    common.discard(written), common.discard(counts)
    many = placed.where(F.col("m") > COPIES).select("*", F.explode(F.sequence(F.lit(0), F.col("m") - 1, F.lit(COPIES))).alias("at")).repartition("g", "k", "at")
    many = many.select("g", "digest", "id", "carried", F.least(F.col("m") - F.col("at"), F.lit(COPIES)).alias("m"), (F.col("k") + F.col("at")).alias("k"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("i")
    return placed.where(F.col("m") <= COPIES).unionByName(many).select("*", each).select("g", (F.col("k") + F.col("i")).alias("k"), "digest", "id", "carried"), placed


def _reduced(leaves: DataFrame, largest: int, what: str) -> tuple[list[DataFrame], DataFrame]:
    """Runs of each level from below, as written tables (g, k, nodes, digest, lone), and the groups' digests (g, level, digest).

    lone: a group's last node, which is its digest and no run. largest: ranks of the largest group.
    """
    levels, tops, nodes, payload = [], [], leaves, [c for c in leaves.columns if c not in ("g", "k")]
    while True:
        runs = nodes.groupBy("g", F.shiftright("k", FANOUT_BITS).alias("k")).agg(F.sort_array(F.collect_list(F.struct("k", *payload))).alias("nodes"))
        lone = (F.col("k") == 0) & (F.size("nodes") == 1)
        levels.append(common.persist(runs.select("g", "k", "nodes", F.when(~lone, F.sha2(_joined(F.col("nodes")), 256)).alias("digest"), lone.alias("lone")), what))
        tops.append(levels[-1].where("lone").select("g", F.lit(len(levels) - 1).alias("level"), F.col("nodes")[0]["digest"].alias("digest")))
        if largest <= 1:
            return levels, reduce(DataFrame.unionByName, tops)
        largest, nodes, payload = (largest + 15) >> FANOUT_BITS, levels[-1].where("not lone").select("g", "k", "digest"), ["digest"]


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Each leaf with its path: what stands left and right of it in its run, then of its run, up to the root. tops: (g, level, subroot, path)."""
    above = None
    for level in range(len(levels) - 1, -1, -1):
        ends = tops.where(F.col("level") == level).select("g", F.lit(0).cast("long").alias("k"), "subroot", "path")
        lone = levels[level].where("lone").join(ends, ["g", "k"]).select("g", "subroot", "path", F.col("nodes")[0].alias("node"))
        nodes = lone
        if above is not None:
            runs = levels[level].where("not lone").drop("digest").join(above.select("g", F.col("node.k").alias("k"), "subroot", "path"), ["g", "k"])
            each = runs.select("g", "subroot", "path", "nodes", F.posexplode("nodes").alias("i", "node"))
            beside = F.struct(_joined(F.slice("nodes", F.lit(1), F.col("i"))).alias("left"), _joined(F.slice("nodes", F.col("i") + 2, F.size("nodes"))).alias("right"))
            nodes = each.select("g", "subroot", F.concat(F.array(beside), F.col("path")).alias("path"), "node").unionByName(lone)
        above = nodes
    return above


def _in_order(tops: DataFrame) -> DataFrame:
    """tops with k, their place by g. Parts are ranges of g; only the parts' counts, one for each, meet in one window."""
    parts = int(tops.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = common.persist(tops.repartitionByRange(parts, "g").sortWithinPartitions("g").select("*", F.monotonically_increasing_id().alias("at")), "merkle-groups")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(counts), "part").select("g", "level", "digest", (F.col("base") + F.col("at").bitwiseAND(F.lit(2**33 - 1))).alias("k"))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, carried: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, carried) of each row.

    path: (left, right) digests beside the row's node in each run, from the leaf's run to the root. Groups are ordered by
    bytes, the null group first. Ids are whole numbers; null ids come first in their group, rows with equal ids are ordered by
    leaf, equal rows follow each other. carried: a column that follows from the fields and comes along. Nulls, empty and
    long texts are leaves like others; no rows give none. Other columns are not read.
    """
    spark = docs.sparkSession
    group = F.coalesce(F.concat(F.lit("+"), F.col(group_col).cast("string")), F.lit("!"))
    kept = carried if carried is not None else F.lit(None).cast("string")
    leaves, placed = _ranked(docs.select(group.alias("g"), F.col(id_col).cast("long").alias("id"), leaf_digest([F.col(c) for c in fields]).alias("digest"), kept.alias("carried")))
    largest = placed.agg(F.max(F.col("k") + F.col("m"))).first()[0]
    if largest is None:
        return leaves.select(F.col("id").alias("doc_id"), *[F.col("digest").alias(c) for c in ("leaf", "subroot", "root")], F.array().cast("array<struct<left:string,right:string>>").alias("path"), "carried")
    levels, tops = _reduced(leaves, largest, "merkle-runs")
    common.discard(placed)
    groups = common.persist(_in_order(tops), "merkle-tops")
    upper, top = _reduced(groups.select(F.lit("").alias("g"), "k", "digest", F.struct("g", "level").alias("group")), groups.count(), "merkle-upper")
    root = top.first()["digest"]
    none = F.array().cast("array<struct<left:string,right:string>>")
    placed_groups = _paths(upper, top.select("g", "level", F.lit(root).alias("subroot"), none.alias("path")))
    ends = common.persist(placed_groups.select(F.col("node.group.g").alias("g"), F.col("node.group.level").alias("level"), F.col("node.digest").alias("subroot"), "path"), "merkle-ends")
    rows = _paths(levels, ends)
    return rows.select(F.col("node.id").alias("doc_id"), F.col("node.digest").alias("leaf"), "subroot", F.lit(root).alias("root"), "path", F.col("node.carried").alias("carried"))


def proof(path: Column) -> Column:
    """sha256 of all digests of a path, left to right in each run, run by run."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda at, x: F.sha2(F.concat(x["left"], at, x["right"]), 256))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's crc32 5 divides are tampered with: their texts' A-Z are lower-cased. The tampered digest comes along with each leaf."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = [F.translate("text", capitals, capitals.lower()) if c == "text" else F.col(c) for c in FIELDS]
    tampered = F.when(common.fold("doc_id", 5) == 0, leaf_digest(changed))
    rows = manifest(common.table(spark, sf_dir, "documents"), carried=tampered)
    back = folded(F.coalesce("carried", "leaf"), F.col("path"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), back.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def _op13_sql(levels: int = 8) -> str:
    """The same, level by level. A group's last node stays as it is on all further levels, and so adds nothing to proofs."""

    def field(c: str, of: str | None = None) -> str:
        return f"coalesce(strlen(CAST({of or c} AS VARCHAR)) || ':' || CAST({of or c} AS VARCHAR), '-')"

    def climb(name: str, group: str) -> list[str]:
        """name_0 (grp, k, d, n) and what stands beside each node, for all levels."""
        out = []
        for i in range(levels):
            out.append(f"""{name}b{i} AS (SELECT *, k // 16 AS up, coalesce(string_agg(d, '') OVER (PARTITION BY grp, k // 16 ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER (PARTITION BY grp, k // 16 ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{i})""")
            out.append(f"""{name}{i + 1} AS (SELECT grp, up AS k, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY k)) END AS d, (any_value(n) + 15) // 16 AS n FROM {name}b{i} GROUP BY grp, up)""")
        return out

    bits = "list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(y.doc_id AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT)), lambda c, b: {bits}))"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = lambda text: "sha256(" + " || ".join(field(c, text if c == "text" else None) for c in FIELDS) + ")"
    ctes = [
        f"x AS (SELECT doc_id, coalesce('+' || source, '!') AS grp, {leaf('text')} AS d, {leaf(low)} AS t FROM documents)",
        "y AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, d) - 1 AS k, count(*) OVER (PARTITION BY grp) AS n FROM x)",
        "a0 AS (SELECT grp, k, d, n FROM y)", *climb("a", "grp"),
        f"z AS (SELECT grp AS name, d, row_number() OVER (ORDER BY encode(grp)) - 1 AS k, count(*) OVER () AS n FROM a{levels})",
        "u0 AS (SELECT 0 AS grp, k, d, n FROM z)", *climb("u", "grp"),
    ]
    joins, steps = [], []
    for name, grp, k in (("a", "y.grp", "y.k"), ("u", "0", "z.k")):
        for i in range(levels):
            joins.append(f"JOIN {name}b{i} AS {name}{i}s ON {name}{i}s.grp = {grp} AND {name}{i}s.k = {k} // {16**i}")
            steps.append(f"{name}{i}s")
        if name == "a":
            joins.append("JOIN z ON z.name = y.grp")
    ctes.append(f"""p0 AS (SELECT y.doc_id, y.d AS leaf, z.d AS subroot, (SELECT d FROM u{levels}) AS root, CASE WHEN {crc} % 5 = 0 THEN y.t ELSE y.d END AS f,
  {' || '.join(f"{s}.l || {s}.r" for s in steps)} AS proof, {', '.join(f"{s}.l AS l{i}, {s}.r AS r{i}, {s}.n AS n{i}" for i, s in enumerate(steps))} FROM y {' '.join(joins)})""")
    for i in range(len(steps)):
        ctes.append(f"p{i + 1} AS (SELECT * REPLACE (CASE WHEN n{i} = 1 THEN f ELSE sha256(l{i} || f || r{i}) END AS f) FROM p{i})")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM p{len(steps)}"


OP13_SQL = _op13_sql()
