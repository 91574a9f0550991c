"""Labels of lines and members: keys to compare them by, readable forms, and what their words say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import clean, let

# What is folded into `other`, letters and digits only.
RESIDUAL = r"^(?:all)?others?(?:countries|country|regions?|areas?|products?|segments?)?(?:notseparatelydisclosed)?$"
# Words that a title keeps in lower case, and that initials leave out.
SMALL_WORDS = ("and", "of", "or", "the", "by", "for", "in", "to")
# Footnote marks at the end of a row's label, and of a member's.
ROW_FOOTNOTE, MEMBER_FOOTNOTE = r"(?:(?<=[a-z]{3})[0-9]{1,2}|\s*\([0-9]{1,2}\)|\s*\([a-z]\))$", r"\s*\((?:[a-z]|[0-9]{1,2})\)$"
MONTHS = "january february march april may june july august september october november december".split()
_PERIOD_WORD = rf"\b({'|'.join(MONTHS)}|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|nov|dec|first|second|third|fourth|q[1-4])\b"
# Words that name a side of a signed figure.
SIGNED = "gain loss recovery chargeoff income expense benefit provision release inflow outflow increase decrease profit credit debit surplus deficit appreciation depreciation earning writeoff writedown".split()


def _or(x: Column, otherwise: Column) -> Column:
    return F.when(x != "", x).otherwise(otherwise)


def member_key(label: Column) -> Column:
    """A member's identity across filings: letters and digits, lower case, `&` as `and`, no bracket at the end, no closing `segment`.

    Labels of the closed list RESIDUAL are all `other`; `Other income` is not. At most 100 characters.
    """
    base = _or(F.regexp_replace(label, r"\([^)]*\)\s*$", ""), label)
    plain = lambda x: F.regexp_replace(F.replace(F.lower(x), F.lit("&"), F.lit("and")), "[^a-z0-9]+", "")
    key = let(plain(base), lambda x: _or(F.regexp_replace(x, "segment$", ""), x))
    return let(key, lambda x: F.when(x.rlike(RESIDUAL), "other").otherwise(F.substring(x, 1, 100)))


def identity(label: Column) -> Column:
    """member_key with `_` as a blank, nanometers as `nm` and `nm3` as `3nm`."""
    key = F.regexp_replace(member_key(F.replace(label, F.lit("_"), F.lit(" "))), "nanometers?", "nm")
    return F.regexp_replace(key, "^nm([0-9]+)$", "$1nm")


def row_key(label: Column) -> Column:
    """A row's key: member_key, with an `r` before it unless a letter begins it, at most 48 characters."""
    return let(member_key(label), lambda x: F.substring(F.when(x.rlike("^[a-z]"), x).otherwise(F.concat(F.lit("r"), x)), 1, 48))


def checked_key(value: Column) -> Column:
    """Lower-case words joined by `_`, beginning with a letter, at most 48 characters; null if nothing is left."""
    cut = lambda x: F.regexp_replace(F.substring(x, 1, 48), "_+$", "")
    key = cut(F.regexp_replace(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "_"), "^_+|_+$", ""))
    return F.nullif(F.when(key.rlike("^[0-9]"), cut(F.concat(F.lit("k_"), key))).otherwise(key), F.lit(""))


def label_key(label: Column) -> Column:
    """Letters only, lower case."""
    return F.regexp_replace(F.lower(label), "[^a-z]", "")


def sideless_key(label: Column) -> Column:
    """member_key with the side of a gain or loss left out."""
    return member_key(F.regexp_replace(F.regexp_replace(label, r"(?i)\s*\((?:gains?|losses?)\)", ""), r"(?i)\b(?:gains?|losses?)\b", "gl"))


def one_sided(label: Column) -> Column:
    """A label that names both sides of a figure, `Gains/(Losses)`, with each side alone; an empty array for others."""
    pattern = r"(?i)^(.*?)\b(gains?|income|profits?|earnings)\s*(?:/|\band\b|\bor\b)?\s*\(?\s*(loss(?:es)?)\s*\)?(.*)$"
    part = lambda i: F.regexp_extract(label, pattern, i)
    sides = F.array(*[F.concat(part(1), part(i), part(4)) for i in (2, 3)])
    return F.when(label.rlike(pattern), sides).otherwise(F.array().cast("array<string>"))


def words(label: Column) -> Column:
    """Words of letters and digits, lower case, in order, without the footnote mark of a row."""
    return F.regexp_extract_all(F.lower(F.regexp_replace(clean(label), ROW_FOOTNOTE, "")), F.lit("[a-z0-9]+"), F.lit(0))


def labels_agree(named: Column, actual: Column) -> Column:
    """Whether a named label is a row's own: one inside the other as joined words, or half the words shared.

    A label without words, null too, has nothing to check and agrees.
    """

    def compare(p: Column) -> Column:
        x, y = p["x"], p["y"]
        a, b = F.array_join(x, ""), F.array_join(y, "")
        fewest = F.least(F.size(F.array_distinct(x)), F.size(F.array_distinct(y)))
        return (F.size(x) == 0) | (F.size(y) == 0) | a.contains(b) | b.contains(a) | (F.size(F.array_intersect(x, y)) >= 0.5 * fewest)

    text = lambda c: F.coalesce(c, F.lit(""))
    return let(F.struct(words(text(named)).alias("x"), words(text(actual)).alias("y")), compare)


def _tail(label: Column, own: Column) -> Column:
    """The longest end of a label whose identity is `own`, empty without one."""
    ends = F.transform(F.sequence(F.lit(1), F.greatest(F.length(label), F.lit(1))), lambda i: F.substring(label, i, F.length(label)))
    return F.coalesce(F.get(F.filter(ends, lambda e: identity(e) == own), 0), F.lit(""))


def tail(label: Column, listed: Column) -> Column:
    """The end of a label that spells a listed name with the same letters and digits, empty without one."""
    return let(identity(listed), lambda own: _tail(label, own))


def _combined(row_label: Column, row: Column, own: Column) -> Column:
    """combined_line of a row's label with its identity and a listed name's. Ends are looked at only where a total or a joint is."""

    def judge(end: Column) -> Column:
        before = F.substring(row_label, F.lit(1), F.length(row_label) - F.length(end))
        joined = before.rlike(r"(?i)(?:&|\band|\+|,|/)\s*$") | row_label.rlike(r"(?i)^\s*total\b")
        return (end != "") & joined

    may = row_label.rlike(r"(?i)[&+,/]|\band|^\s*total\b")
    return F.when((row != own) & may, let(_tail(row_label, own), judge)).otherwise(False)


def combined_line(row_label: Column, listed: Column) -> Column:
    """Whether a row ends with a listed name but adds a total or a joined part: a subtotal that holds the line, not the line."""
    return let(F.struct(identity(row_label).alias("row"), identity(listed).alias("own")), lambda x: _combined(row_label, x["row"], x["own"]))


def listed_item(label: Column, items: Column) -> Column:
    """The listed item (struct key, label) that a row's label names, null for none or several.

    Tried in order: the same identity; a label that ends with a listed one of eight letters at least, not after a
    joining word; one side of a two-sided listed label; the same again without a footnote number set apart.
    """
    bare = F.regexp_replace(label, r"\s+[0-9]{1,2}$", "")
    known = F.transform(items, lambda k: F.struct(k.alias("item"), identity(k["label"]).alias("own"), identity(k["key"]).alias("key")))

    def matched(text: Column, known: Column) -> Column:
        def steps(row: Column) -> Column:
            same = F.filter(known, lambda k: (row == k["own"]) | (row == k["key"]))
            ending = F.filter(known, lambda k: (F.length(k["own"]) >= 8) & F.endswith(row, k["own"]) & ~_combined(text, row, k["own"]))
            side = F.filter(known, lambda k: F.exists(one_sided(k["item"]["label"]), lambda s: identity(s) == row))
            return _first(same, lambda: _first(ending, lambda: side))

        return let(identity(text), steps)

    def named(known: Column) -> Column:
        found = let(matched(label, known), lambda own: F.when((F.size(own) == 0) & (bare != label), matched(bare, known)).otherwise(own))
        return let(found, lambda x: F.when(F.size(x) == 1, F.get(x, 0)["item"]))

    return let(known, named)


def _first(found: Column, otherwise) -> Column:
    """An array, or another where it is empty."""
    return let(found, lambda x: F.when(F.size(x) > 0, x).otherwise(otherwise()))


def without_footnote(label: Column) -> Column:
    """A member's label without the mark `(a)` or `(12)` at its end; a label of a mark alone stays."""
    return _or(F.trim(F.regexp_replace(label, MEMBER_FOOTNOTE, "")), label)


def row_label(label: Column) -> Column:
    """A row's label without the footnote mark run into it: `devices(1)`, `Management14`."""
    return F.trim(F.regexp_replace(label, ROW_FOOTNOTE, ""))


def initials(name: Column) -> Column:
    """First letters of a name's words but small ones: `Consumer & Community Banking` is CCB."""
    each = F.regexp_extract_all(name, F.lit(r"[A-Za-z][\w'-]*"), F.lit(0))
    return F.upper(F.array_join(F.transform(F.filter(each, lambda w: ~F.lower(w).isin(*SMALL_WORDS)), lambda w: F.left(w, F.lit(1))), ""))


def names_segment(title: Column, name: Column) -> Column:
    """Whether a title names a segment in full, by letters and digits, or by its initials as a word of its own."""
    plain = lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]", "")
    whole = F.contains(plain(title), plain(name))
    return whole | let(initials(name), lambda s: (F.length(s) >= 2) & F.array_contains(F.regexp_extract_all(title, F.lit(r"\w+"), F.lit(0)), s))


def humanize(member: Column) -> Column:
    """CamelCase as words: `ChinaIncludingHongKongMember` becomes `China Including Hong Kong`."""
    base = F.regexp_replace(local_name(member), "(SegmentMember|Member|Axis)$", "")
    spaced = F.regexp_replace(F.regexp_replace(base, "([a-z0-9])([A-Z])", "$1 $2"), "([A-Z])([A-Z][a-z])", "$1 $2")
    return let(base, lambda b: _or(F.trim(spaced), b))


def local_name(qname: Column) -> Column:
    return F.regexp_replace(qname, "^[^:]*:", "")


def axis_name(column: Column) -> Column:
    """`dim_us-gaap_StatementBusinessSegmentsAxis` is StatementBusinessSegmentsAxis."""
    return F.regexp_replace(column, "^dim_(?:[^_]+_(?=.))?", "")


def title_case(label: Column) -> Column:
    """Words in lower case capitalised, small ones but the first left; acronyms and brand casing stay as written."""
    lower = lambda w: (w == F.lower(w)) & w.rlike("[a-z]")
    one = lambda w, i: F.when(~lower(w) | ((i > 0) & w.isin(*SMALL_WORDS)), w).otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2))))
    return F.array_join(F.transform(F.split(clean(label), " "), one), " ")


def quote_template(quote: Column) -> Column:
    """A sentence with period words as `@` and numbers as `#`, so that next quarter's is equal."""
    return F.regexp_replace(F.regexp_replace(F.lower(clean(quote)), _PERIOD_WORD, "@"), "[0-9.,]+", "#")


def source_template(url: Column) -> Column:
    """A file name in lower case without its digits."""
    return F.regexp_replace(F.lower(F.substring_index(url, "/", -1)), "[0-9]+", "")


def anchor_words(quote: Column, value_text: Column, count: int) -> Column:
    """The last words before a quote's figure, lower case; null if they are fewer or the figure isn't in the quote exactly once."""
    q, v = clean(quote), clean(value_text)
    once = (v != "") & q.contains(v) & (F.size(F.split(q, F.concat(F.lit(r"\Q"), v, F.lit(r"\E")), -1)) == 2)
    before = F.regexp_extract_all(F.split_part(q, v, F.lit(1)), F.lit(r"[A-Za-z][A-Za-z'-]*"), F.lit(0))
    return F.when(once & (F.size(before) >= count), F.transform(F.slice(before, F.size(before) - count + 1, count), F.lower))


_SLOT = r"(?:\$\s?)?\(?[-+]?\$?[0-9][0-9,]*(?:\.[0-9]+)?\)?%?x?|[—–-]{1,2}%?"


def row_line(quote: Column, value_text: Column) -> Column:
    """struct(label, slots, index) of a row quoted as a line: words, then two figures or more, one of them the value; else null.

    The label loses its footnote mark; index is the value's place among the figures, from 0. A dash is a figure too.
    """
    text = F.regexp_replace(clean(quote), r"\$\s+(?=[(0-9-])", r"\$")
    figures = F.regexp_extract(text, rf"((?:(?:^|\s)(?:{_SLOT})(?=\s|$))+)$", 1)
    slots = F.array_remove(F.split(F.trim(figures), " "), "")
    label = F.trim(F.regexp_replace(F.trim(F.substring(text, F.lit(1), F.length(text) - F.length(figures))), r"(?<=[A-Za-z)])[0-9]{1,2}(?:,[0-9]{1,2})*$", ""))
    v = clean(value_text)
    own = F.filter(F.transform(slots, lambda s, i: F.when(s.contains(v), i)), lambda i: i.isNotNull())
    ok = (F.size(slots) >= 2) & label.rlike("[A-Za-z]{2}") & (F.size(own) == 1)
    return F.when(ok, F.struct(label.alias("label"), slots.alias("slots"), F.get(own, 0).alias("index")))


def fit_label(label: Column, most: int = 80) -> Column:
    """At most `most` characters, cut after a whole word and without a mark left at its end; shorter ones as they are."""
    text = F.substring(F.trim(label), 1, most + 1)
    cut = F.when(text.contains(" "), F.regexp_extract(text, r"^(.*) ", 1)).otherwise(F.substring(text, 1, most))
    return F.when(F.length(F.trim(label)) <= most, label).otherwise(F.regexp_replace(cut, r"[ ,;:(-]+$", ""))


def forward_looking(text: Column) -> Column:
    """A statement about the future: we expect, guidance, outlook, will be; not `expected to be recognized`."""
    # Words of statements about the future, and the one form that is none.
    who = r"\b(?:we|management|the company)\s+(?:now\s+)?(?:expects?|anticipates?|forecasts?|projects?|plans?|targets?|guides?)\b"
    return text.rlike(rf"(?i){who}|\bguidance\b|\boutlook\b|\bwill be\b|\b(?:is|are) expected to\b(?! be recogni)")


def falls(quote: Column, value_text: Column) -> Column:
    """Whether a quote calls its figure a fall: `decreased by 16%`, but not the level of `declined to 30%`."""
    # Fixed value: words of a fall up to a figure.
    fall = r"(?i)\b(?:decreas\w*|declin\w*|fell|falls?|falling|dropped|drops?|down|lower|contracted|reduc\w*)(?:\s+(?!to\b|from\b)[A-Za-z][\w-]*){0,6}?\s*(?:\b(?:by|of|was|were)\s*)?$"
    return quote.contains(value_text) & F.right(F.split_part(quote, value_text, F.lit(1)), F.lit(80)).rlike(fall)


def net_gross_mismatch(text: Column, label: Column) -> Column:
    """`net` or `gross` where a text names one and a label the other; null if they agree or either names none or both."""
    only = lambda c: F.when(c.rlike(r"(?i)\bnet\b") & ~c.rlike(r"(?i)\bgross\b"), "net").when(c.rlike(r"(?i)\bgross\b") & ~c.rlike(r"(?i)\bnet\b"), "gross")
    return F.when(only(text) != only(label), only(text))


def part_row(row_label: Column, label: Column) -> Column:
    """Whether a row is the `Other X` of an item X that isn't a residual itself."""
    plain = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z ]", " "), r"\s+", " "))
    row, line = plain(row_label), plain(label)
    rest = F.regexp_replace(row, "^(?:all )?other ", "")
    return (line != "") & ~line.startswith("other") & row.rlike("^(?:all )?other ") & ((rest == line) | (rest == F.concat(line, F.lit("s"))))


def _sign_word(word: Column) -> Column:
    w = F.regexp_replace(F.lower(word), "[^a-z]", "")
    return F.when(w.endswith("ies"), F.concat(F.regexp_replace(w, "ies$", ""), F.lit("y"))).when(w.endswith("sses"), F.regexp_replace(w, "es$", "")).when(w.endswith("s") & ~w.endswith("ss"), F.regexp_replace(w, "s$", "")).otherwise(w)


def _sign_pairs(label: Column) -> Column:
    """(positive, negative) pairs of signed words: the word in brackets is the negative one."""
    word = "[A-Za-z][A-Za-z-]*"
    found = []
    for pattern, flipped in ((rf"({word})\s*/?\s*\(\s*({word})\s*\)", False), (rf"\(\s*({word})\s*\)\s*/\s*({word})", True)):
        sides = [F.regexp_extract_all(label, F.lit(pattern), F.lit(i)) for i in ((2, 1) if flipped else (1, 2))]
        found.append(F.zip_with(*sides, lambda p, n: F.struct(_sign_word(p).alias("p"), _sign_word(n).alias("n"))))
    return F.filter(F.concat(*found), lambda x: x["p"].isin(*SIGNED) & x["n"].isin(*SIGNED) & (x["p"] != x["n"]))


def opposite_convention(row_label: Column, label: Column, ratio: bool = False) -> Column:
    """Whether a row states a line's sign convention the other way round; a ratio's row may name the negative side alone."""
    each = lambda c: F.transform(F.regexp_extract_all(c, F.lit("[A-Za-z][A-Za-z-]*"), F.lit(0)), _sign_word)
    text = lambda c: F.coalesce(c, F.lit(""))
    row, own = _sign_pairs(text(row_label)), _sign_pairs(text(label))
    out = F.exists(own, lambda x: F.exists(row, lambda y: (y["p"] == x["n"]) & (y["n"] == x["p"])))
    if ratio:
        outside = each(F.regexp_replace(text(row_label), r"\([^)]*\)", " "))
        out = out | ((F.size(row) == 0) & F.exists(own, lambda x: F.array_contains(outside, x["n"]) & ~F.array_contains(each(text(row_label)), x["p"])))
    return out


def is_residual(label: Column) -> Column:
    """Whether a label is a list's or a row's `Other`: `All other`, `Other (1)`."""
    w = F.array_join(words(F.coalesce(label, F.lit(""))), " ")
    return w.isin("other", "all other")


def line_kind(label: Column) -> Column:
    """amount, per_share or share_count."""
    x = F.lower(label)
    return F.when(x.rlike(r"per (ordinary |common )?share|per unit"), "per_share").when(x.rlike(r"(shares|units) (outstanding|issued)|number of shares"), "share_count").otherwise("amount")


def classify(first: Column, second: Column) -> Column:
    """Three-valued: true where only the first test holds, false where only the second does, else null."""
    return F.when(first & ~second, F.lit(True)).when(second & ~first, F.lit(False))


def excerpt_titles(excerpt: Column, most: int = 240) -> Column:
    """The opening of each exhibit of an excerpt (blank lines part them), as one text."""
    return F.array_join(F.transform(F.split(excerpt, "\n\n"), lambda p: F.substring(p, 1, most)), " | ")


def template_words(template: Column) -> Column:
    """A template's words without its blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(template, "[@#]", " "), r"\s+", " "))
