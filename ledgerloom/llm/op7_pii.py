"""Operator 7: personal data by fixed forms, then by contexts learned from what the forms found. Spark expressions only.

1. One pass over the texts writes, for each document, what the forms and a form for identifier-like tokens match, with
   the text's length before each match and the two words before each token. No text is kept.
2. Matches become spans by running sums within a document. Valid ones are the seeds.
   Seeds too are secrets: long hexadecimal tokens of digits and letters. They are reported with what the method adds.
3. The last one and two words before a span, and a key glued to it as in `key=value`, are its patterns. Any word counts,
   those with digits too. A form's match begins within a token: its words are what is before it in that token, if there
   is something, and then the token's. Patterns and instances (the matched strings) form a graph, counted over distinct
   instances, so copies of a document count once.
4. In each round patterns are scored by how many distinct known instances they precede and which share of all that
   is, against the share that chance would give: that of all instances. Instances behind trusted patterns become known,
   and are seeds of the next round, until a round adds none. What a form matches but rejects, as a number of a card's
   length with a wrong check digit, is evidence against a pattern and is never added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
#: What the method adds to the fixed kinds.
FOUND = "id"
# Each form matches what the plain one would, but never rescans: a match can only begin where a run begins or where the
# last match ended, and repeats never give back.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A token with a digit or @.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_SPACE = r"[\x20\x09-\x0D]+"
#: Longer words and instances are told apart by their hash, so that the graph stays small.
LONGEST = 80
#: Shorter tokens are personal only where they stand behind a trusted pattern; a `5` or `2nd` elsewhere is none.
SHORTEST = 6
#: Parts that the occurrences behind one pattern are dealt to.
SALTS = 16
#: Tokens that are secrets in themselves.
SECRET = r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{32,}+$"
#: A trusted pattern precedes so many distinct known instances, and so large a share of all it precedes; its unknown share
#: is at most this part of all instances' one, and its known ones exceed chance by so many standard deviations.
LEAST_KNOWN, LEAST_SHARE, MOST_UNKNOWN, DEVIATIONS = 5, 0.6, 0.5, 2.0
HOT = 0.001


_MATCHES = "array<struct<kind:int,idx:int,before:int,match:string,w1:string,w2:string>>"


def _matches(text: Column, kind: int, form: str, guard: Column, words: Column | None = None) -> Column:
    """array of (kind, idx, before, match, w1, w2): before is the length of text since the last match's end.

    `words` gives the last word and the one before it for each match in order.
    """
    from .op3_rules import let

    found, no = F.when(guard, F.regexp_extract_all(text, F.lit(form), F.lit(0))), F.lit(None).cast("string")

    def rows(m: Column) -> Column:
        parts = [m.alias("m"), F.slice(F.split(text, form), F.lit(1), F.size(m)).alias("p")]
        both = F.arrays_zip(*parts, *([] if words is None else [words.alias("w")]))
        w = lambda z, k: no if words is None else z["w"][k]
        one = lambda z, i: F.struct(F.lit(kind).alias("kind"), i.alias("idx"), F.length(z["p"]).alias("before"), z["m"].alias("match"), w(z, "w1").alias("w1"), w(z, "w2").alias("w2"))
        return F.when(F.size(m) > 0, F.transform(both, one))

    return F.coalesce(let(found, rows), F.array().cast(_MATCHES))


def _words_before(text: Column) -> Column:
    """array of (w1, w2), the last word and the one before it, for each word with a digit or @, which TOKEN matches."""
    from .op3_rules import let

    before = lambda a, i: F.struct(_named(F.get(a, i - 1)).alias("w1"), _named(F.get(a, i - 2)).alias("w2"))
    each = lambda a: F.array_compact(F.transform(a, lambda w, i: F.when(w.rlike("[0-9@]"), before(a, i))))
    return let(F.array_remove(F.split(text, _SPACE), ""), each)


def _named(word: Column) -> Column:
    """A word in lower case with its digits as 0; a long one by its hash."""
    form = F.regexp_replace(F.lower(word), "[0-9]", "0")
    return F.when(F.length(form) > LONGEST, F.sha2(form, 256)).otherwise(form)


def _valid(kind: Column, match: Column) -> Column:
    """Whether a match of a form is one; tokens are judged later."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    at = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(i % 2 == 0, d.cast("int")).when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2))
    luhn = F.aggregate(at, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0
    n = F.length(digits)
    return (
        F.when(kind == 1, match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(kind == 2, F.when((n >= 16) & (n <= 19), luhn).otherwise(False))
        .when(kind == 3, (n >= 8) & (n <= 15))
        .otherwise(True)
    )


def matched(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, found) of every row, written; row numbers the rows of this writing."""
    text = common.text_of(text_col)
    some, at = text.rlike("[0-9]"), text.contains("@")
    guards = {"email": at, "ip": some, "card": some, "phone": text.contains("+")}
    tokens = _matches(text, len(KINDS), TOKEN, some | at, _words_before(text))
    found = F.concat(*[_matches(text, k, FORMS[n], guards[n]) for k, n in enumerate(KINDS)], tokens)
    return common.persist(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), found.alias("found")), "pii-matches")


def _rejected() -> Column:
    """Whether a token as a whole (column `core`) is of a form but isn't valid."""
    whole = lambda k: F.col("core").rlike(f"^(?:{FORMS[KINDS[k]]})$")
    n, ok = F.length(F.regexp_replace("core", "[^0-9]", "")), lambda k: F.coalesce(_valid(F.lit(k), F.col("core")), F.lit(False))
    return (whole(1) & ~ok(1)) | (whole(2) & n.between(16, 19) & ~ok(2)) | (whole(3) & ~ok(3))


def _spans(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end, instance, n, secret, rejected, patterns) of every valid match; tokens lose marks at either end."""
    token = F.col("kind") == len(KINDS)
    each = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("x")).select("row", "x.*").repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = F.sum(F.col("before") + F.length("match")).over(so_far)
    each = each.withColumn("end", ends.cast("int")).where(_valid(F.col("kind"), F.col("match"))).withColumn("start", F.col("end") - F.length("match"))
    in_order = Window.partitionBy("row").orderBy("start", F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    around = F.last(F.when(token, F.struct("start", "match", "w1", "w2")), ignorenulls=True)
    each = each.withColumn("t", around.over(in_order))
    glued = F.when(~token, F.nullif(F.substring(F.col("t.match"), F.lit(1), F.col("start") - F.col("t.start")), F.lit("")))
    each = each.select("row", "kind", "start", "match", _named(glued).alias("glued"), "t.w1", "t.w2")
    head = F.when(token, F.length(F.regexp_extract("match", r"^\p{Punct}*", 0))).otherwise(0)
    core = F.when(token, F.regexp_replace("match", r"^\p{Punct}+|\p{Punct}+$", "")).otherwise(F.col("match"))
    each = each.withColumn("start", F.col("start") + head).withColumn("core", core).withColumn("end", F.col("start") + F.length("core"))
    last, second = F.coalesce("glued", "w1"), F.when(F.col("glued").isNull(), F.col("w2")).otherwise(F.col("w1"))
    key = F.lower(F.nullif(F.regexp_extract("core", r"^([A-Za-z_][A-Za-z_-]*[=:])", 1), F.lit("")))
    patterns = F.array_compact(F.array(F.concat(F.lit("1 "), last), F.concat(F.lit("2 "), second, F.lit(" "), last), F.concat(F.lit("k "), key)))
    n, instance = F.length("core"), F.lower("core")
    instance = F.when(n > LONGEST, F.sha2(instance, 256)).otherwise(instance)
    secret, rejected = token & F.lower("core").rlike(SECRET), token & _rejected()
    return each.select("row", "kind", "start", "end", instance.alias("instance"), n.alias("n"), secret.alias("secret"), rejected.alias("rejected"), patterns.alias("patterns"))


def _introduced(unknown: DataFrame, scored: DataFrame, trusted: DataFrame) -> DataFrame:
    """Unknown instances with the scores of the trusted patterns before them.

    Patterns with more than a part HOT of all edges, 1 / HOT at most, are broadcast, so none of them fills a task.
    """
    total = scored.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(scored.where(F.col("n") > HOT * total).select("pattern", F.lit(True).alias("hot")))
    marked = unknown.join(hot, "pattern", "left")
    few = F.broadcast(trusted.join(hot, "pattern").select("pattern", "score"))
    many = trusted.hint("shuffle_hash")
    return marked.where("hot").select("pattern", "instance").join(few, "pattern").union(marked.where("hot is null").select("pattern", "instance").join(many, "pattern"))


def learned(spans: DataFrame, least_known: int = LEAST_KNOWN, least_share: float = LEAST_SHARE, rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(instance, confidence): tokens that trusted patterns introduce, and the best of these patterns' scores; and (pattern, f, n), the trusted patterns.

    Rounds go on until one adds nothing, or to `rounds` if given. Tokens below SHORTEST are no evidence and are not found here.
    """
    token = len(KINDS)
    long_enough = (F.col("kind") < token) | (F.col("n") >= SHORTEST)
    uses = spans.where(long_enough).select(F.explode("patterns").alias("pattern"), "instance", ((F.col("kind") < token) | F.col("secret")).alias("seed"), "rejected")
    edges = common.persist(uses.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.max("rejected").alias("rejected")), "pii-graph")
    instances = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    everyone, seeded = instances.agg(F.count("*"), F.count_if("seed")).first()
    seeds = instances.where("seed").select("instance")
    found, size, done = None, 0, 0
    while rounds is None or done < rounds:
        known = (seeds if found is None else seeds.union(found.select("instance"))).withColumn("known", F.lit(True))
        graph = edges.join(known.hint("shuffle_hash"), "instance", "left").withColumn("known", F.coalesce("known", F.lit(False)))
        scored = graph.groupBy("pattern").agg(F.sum(F.col("known").cast("long")).alias("f"), F.count("*").alias("n"))
        chance, f, n = (seeded + size) / max(1, everyone), F.col("f"), F.col("n")
        above = (n - f <= MOST_UNKNOWN * (1 - chance) * n) & (f - chance * n >= DEVIATIONS * F.sqrt(n * (chance * (1 - chance))))
        trusted = scored.where((f >= least_known) & (f >= least_share * n) & above)
        trusted = trusted.select("pattern", (f / n * F.log2("f")).alias("score"), "f", "n")
        new = _introduced(graph.where(~F.col("known") & ~F.col("rejected")), scored, trusted.select("pattern", "score")).groupBy("instance").agg(F.max("score").alias("confidence"))
        found = common.persist(new if found is None else found.union(new), "pii-found")
        last, size, done = size, found.count(), done + 1
        if size == last:
            break
    return found, trusted.select("pattern", "f", "n")


def _short(tokens: DataFrame, trusted: DataFrame, least_share: float) -> DataFrame:
    """(row, kind, start, end) of short tokens behind trusted patterns that stay trusted with all short tokens behind them counted as unknown.

    Occurrences are dealt by pattern and a salt, so one frequent pattern is several tasks.
    """
    short = tokens.where((F.col("n") < SHORTEST) & ~F.col("rejected")).select("row", "kind", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    salted = short.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    ready = trusted.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    behind = salted.join(ready.hint("shuffle_hash"), ["pattern", "salt"])
    different = behind.groupBy("pattern", "f", "n", "instance").agg(F.lit(1).alias("one")).groupBy("pattern", "f", "n").agg(F.count("*").alias("short"))
    still = different.where(F.col("f") >= least_share * (F.col("n") + F.col("short"))).select("pattern", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return behind.join(still.hint("shuffle_hash"), ["pattern", "salt"]).select("row", "kind", "start", "end").distinct()


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_known: int = LEAST_KNOWN, least_share: float = LEAST_SHARE, rounds: int | None = None) -> DataFrame:
    """(row, id, spans, n_email, n_ip, n_card, n_phone, n_id) of every document row.

    spans: (kind, start, end), by kind and then start, in code points with the end exclusive; kind 0 to 3 are the forms,
    4 is what the method adds: secrets, tokens that trusted patterns introduce anywhere, and short ones (below SHORTEST) behind such
    a pattern only, where no form's span lies. Null and
    empty texts have none. Repeated rows count once as evidence and are each reported. Other columns are not read.
    """
    rows = matched(docs, id_col, text_col)
    spans = common.persist(_spans(rows), "pii-spans")
    token = len(KINDS)
    tokens = spans.where((F.col("kind") == token) & (F.col("end") > F.col("start")))
    found, trusted = learned(spans, least_known, least_share, rounds)
    new = tokens.where(~F.col("secret")).join(found.select("instance").hint("shuffle_hash"), "instance")
    new = new.select("row", "kind", "start", "end").union(tokens.where("secret").select("row", "kind", "start", "end")).union(_short(tokens, trusted, least_share))
    kept = spans.where(F.col("kind") < token).select("row", "kind", "start", "end").union(new.select("row", "kind", "start", "end"))
    by_row = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < token)
    added = F.filter("all", lambda s: (s["kind"] == token) & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    by_row = by_row.select("row", F.concat(base, added).alias("spans"))
    out = rows.select("row", "id").join(by_row.hint("shuffle_hash"), "row", "left")
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    out = out.select("row", "id", F.coalesce("spans", none).alias("spans"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return out.select("*", *[count(k).alias(f"n_{n}") for k, n in enumerate((*KINDS, FOUND))])


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, (*KINDS, FOUND)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_spans(common.table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    return found.select(
        F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), "n_id",
    )


def disjoint(found: DataFrame) -> DataFrame:
    """(id, spans) with spans (start, end, kind) in order; spans that overlap become one, of the kind that begins first."""
    each = found.select("id", F.explode("spans").alias("s")).select("id", "s.*")
    w = Window.partitionBy("id").orderBy("start", "end", "kind")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("new", F.coalesce(before <= F.col("start"), F.lit(True)).cast("int"))
    each = each.withColumn("part", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    one = each.groupBy("id", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "end", "kind")).alias("kind"))
    return one.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with each of the disjoint spans, in order, replaced by its kind in brackets."""
    from .op3_rules import let

    names = F.array(*map(F.lit, (*KINDS, FOUND)))

    def whole(a: Column) -> Column:
        last = lambda i: F.coalesce(F.get(a, i - 1)["end"], F.lit(0))
        piece = F.transform(a, lambda s, i: F.concat(F.substring(text, last(i) + 1, s["start"] - last(i)), F.lit("["), F.element_at(names, s["kind"] + 1), F.lit("]")))
        return F.concat(F.array_join(piece, ""), F.substring(text, F.element_at(a, -1)["end"] + 1, F.length(text)))

    return let(spans, whole)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars follows.

    Spans go back to their own row by a key written with the documents, so repeated and null ids are masked like others.
    """
    docs, columns = common.with_key(docs), docs.columns
    found = disjoint(found_spans(docs, common.KEY).where(F.size("spans") > 0))
    joined = docs.alias("d").join(found.hint("shuffle_hash").alias("f"), F.col(f"d.{common.KEY}") == F.col("f.id"), "left")
    spans, text = F.col("f.spans"), F.col("d.text")
    new = {"text": F.when(spans.isNull() | text.isNull(), text).otherwise(masked(text, spans))}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(spans.isNull(), F.col("d.n_chars")).otherwise(F.length(new["text"])).cast(kind)
    return joined.select(*[new[c].alias(c) if c in new else F.col(f"d.`{c}`") for c in columns])
