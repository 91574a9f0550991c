"""Operator 3: quality rules as learned decision lists, evaluated by Spark expressions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, labelled

SPACE, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
#: Labelled documents that rules are learned from, at most.
MOST_LABELLED = 6000
#: What conditions may be about, all of it columns of statistics().
MEASURES = ("symbol_share", "upper_share", "bang_share", "repeat_share", "distinct_share", "dup_line_share", "word_length", "n_words")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body uses it within lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """Words in windows of WINDOW words that the text has twice or more.

    Windows are told apart by a 64-bit hash, of two hashes of half as many words, down to a word's. If all differ, which is the usual case, nothing is sorted.
    """
    n = F.size(words)

    def doubled(k: int) -> Callable[[Column], Column]:
        """Hashes of runs of k words to those of runs of 2k."""
        left = lambda g: F.greatest(F.size(g) - k, F.lit(0))
        return lambda g: F.zip_with(F.slice(g, F.lit(1), left(g)), F.slice(g, F.lit(k + 1), left(g)), lambda a, b: F.xxhash64(a, b))

    windows = F.transform(words, lambda w: F.xxhash64(w))
    for k in (1, 2, 4):
        windows = let(windows, doubled(k))

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    def twice(pairs: Column) -> Column:
        same = lambda e, i: F.coalesce(F.get(pairs, i - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(pairs, i + 1)["h"] == e["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(pairs, same), lambda e: e["i"]))

    hard = lambda w: let(let(F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), twice), covered)
    found = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(hard(w)))
    return F.when(n < WINDOW, F.lit(0).cast("long")).otherwise(found)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, measures) of every row.

    A null text has no words. Shares of nothing are 0, except that distinct_share is then 1. Other columns aren't read.
    """
    text = common.text_of(text_col)
    count = lambda marks: (F.length(text) - F.length(F.regexp_replace(text, marks, ""))).cast("long")
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("d"), _repeated(w).alias("r")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    rows = docs.select(
        F.col(id_col), *carry, of_words.alias("w"), of_lines.alias("l"), F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"), count("[A-Z]").alias("n_upper"), count("!").alias("n_bangs"),
    )
    share = lambda x, of: F.coalesce(F.col(x) / F.nullif(F.col(of), F.lit(0)), F.lit(0.0))
    rows = rows.select("*", F.col("w.n").alias("n_words"), F.col("l.d").alias("n_dup_lines"), F.col("w.r").alias("n_repeat_words"))
    return rows.select(
        id_col, *carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("n_symbols", "word_chars").alias("symbol_share"), share("n_upper", "word_chars").alias("upper_share"), share("n_bangs", "n_words").alias("bang_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"), F.coalesce(F.col("w.d") / F.nullif("n_words", F.lit(0)), F.lit(1.0)).alias("distinct_share"),
        share("n_dup_lines", "l.n").alias("dup_line_share"), share("word_chars", "n_words").alias("word_length"),
    )


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    value: float

    def holds(self, row: dict) -> bool:
        return (row[self.measure] > self.value) == self.above

    def column(self) -> Column:
        return F.col(self.measure) > self.value if self.above else F.col(self.measure) <= self.value


Rule = tuple[Condition, ...]


def _cuts(values: list[float], most: int = 24) -> list[float]:
    """Middles between neighbouring values, at most `most` of them, evenly by rank."""
    v = sorted(set(values))
    mids = [(a + b) / 2 for a, b in zip(v, v[1:])]
    return mids if len(mids) <= most else [mids[i * len(mids) // most] for i in range(most)]


def learn(rows: list[dict], bad: list[bool], most_rules: int = 8, most_conditions: int = 3, least_precision: float = 0.9) -> list[Rule]:
    """Sequential covering: rules for `bad`, each grown on two thirds of what no earlier rule covers, pruned on the rest.

    Growing adds the condition of highest information gain until no good row is covered; pruning drops last conditions
    while precision on the other third doesn't fall. A rule below `least_precision` on all rows ends the list.
    """
    import math

    left, rules = list(range(len(rows))), []
    while len(rules) < most_rules and sum(bad[i] for i in left) >= 3:
        grow, prune = [i for k, i in enumerate(left) if k % 3], left[::3]
        rule: Rule = ()
        inside = grow
        while len(rule) < most_conditions and any(not bad[i] for i in inside):
            p0 = sum(bad[i] for i in inside)
            if not p0:
                break
            base, best = math.log2(p0 / len(inside)), (0.0, None)
            for m in MEASURES:
                order = sorted(inside, key=lambda i: rows[i][m])
                cuts, at, pos = _cuts([rows[i][m] for i in inside if bad[i]] + [rows[i][m] for i in inside[:: max(1, len(inside) // 200)]]), 0, 0
                for c in cuts:
                    while at < len(order) and rows[order[at]][m] <= c:
                        pos += bad[order[at]]
                        at += 1
                    for above, p, n in ((False, pos, at), (True, p0 - pos, len(order) - at)):
                        if p and (gain := p * (math.log2(p / n) - base)) > best[0] + 1e-9:
                            best = (gain, Condition(m, above, c))
            if best[1] is None:
                break
            rule += (best[1],)
            inside = [i for i in inside if best[1].holds(rows[i])]
        if not rule:
            break

        def worth(r: Rule, over: list[int]) -> tuple[float, int]:
            c = [bad[i] for i in over if all(x.holds(rows[i]) for x in r)]
            return (sum(c) / len(c) if c else 0.0), len(c)

        while len(rule) > 1 and worth(rule[:-1], prune)[0] >= worth(rule, prune)[0]:
            rule = rule[:-1]
        precision, n = worth(rule, left)
        if precision < least_precision or not n:
            break
        rules.append(rule)
        left = [i for i in left if not all(x.holds(rows[i]) for x in rule)]
    return rules


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1, or null: an ordered conditional expression."""
    out = None
    for k, rule in enumerate(rules, 1):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(k)) if out is None else out.when(test, F.lit(k))
    return F.lit(None).cast("int") if out is None else out.cast("int")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST_LABELLED) -> list[Rule]:
    """The list, from statistics of at most `most` labelled documents that aren't held out; empty without labels."""
    sample = labelled.sample(docs, labels, [label_col], most, id_col, text_col)
    got = [r.asDict() for r in statistics(sample, id_col, text_col, (f"label_{label_col}",)).orderBy(F.xxhash64(id_col), id_col).collect()]
    return learn(got, [not r[f"label_{label_col}"] for r in got])


def verdicts(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """statistics() with base_failed, rule (the first that holds, or null) and kept, of every document row."""
    rows = statistics(docs, id_col, text_col)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select("*", failed.alias("base_failed"), decision(rules).alias("rule")).select("*", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"))


def op3_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return verdicts(docs, fit(docs, common.table(spark, sf_dir, "labels")))
