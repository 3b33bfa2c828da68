"""Personal data: fixed forms, and identifiers found through their contexts by bootstrapping.

Four kinds have a fixed form (e-mail, IP address, card and phone number). Their matches are the seeds of a bootstrap:
a lexical pattern is the word before an identifier, or what a token has before ``=`` or ``:``. In each round a pattern's
precision is the share of its occurrences that hold known instances; precise patterns with enough different instances
make the other identifier-like tokens in their slots known, which in turn support further patterns, until nothing new is
found. Everything is DataFrame expressions and joins over a graph of patterns and instances.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.llm.common import Scratch, body, col, membership

KINDS = ["email", "ip", "card", "phone"]

# The forms of the four kinds. Possessive and anchored at the start of a run, so that long runs of one
# class of characters are read once: same matches, linear time, no recursion.
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without these has no match that passes; cheaper than the forms.
SIGNS = {"email": r"@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@=]*+[0-9@=][^\x20\x09-\x0D]*+"
BLANKS = r"[\x20\x09-\x0D]+"
HEAD = r"^([^=:]+[=:])."
SPAN = "array<struct<kind:string,start:int,end:int,found:string,before:string>>"
SEED = "array<struct<pattern:string,instance:string,first:boolean>>"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits' Luhn sum is a multiple of ten."""
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(found)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


def _last_word(gap: Column) -> Column:
    """The last word of a text, empty where there is none; read from the end, so that it takes linear time."""
    return F.reverse(F.regexp_extract(F.reverse(gap), r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]*+)", 1))


def located(text: Column, form: str, sign: str, kind: str, words: bool = False) -> Column:
    """All matches of a form, leftmost and without overlap, with code point positions.

    The text between matches and the matches themselves alternate; their lengths add up to the positions. If the form
    matches whole ``words``, ``before`` is the whole word before each: the gap's last one, or the match before the gap.
    """
    parts = F.arrays_zip(F.split(text, form, -1).alias("gap"), F.regexp_extract_all(text, F.lit(form), F.lit(0)).alias("found"))

    def take(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["gap"])
        end = start + F.char_length(part["found"])
        before = F.coalesce(F.nullif(_last_word(part["gap"]), F.lit("")), state["last"]) if words else F.lit("")
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), part["found"].alias("found"), before.alias("before"))
        last = part["found"] if words else state["last"]
        return F.when(part["found"].isNull(), state).otherwise(
            F.struct(end.alias("at"), last.alias("last"), F.concat(state["spans"], F.array(span)).alias("spans"))
        )

    none = F.array().cast(SPAN)
    spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.lit("").alias("last"), none.alias("spans")), take)["spans"]
    return F.when(text.rlike(sign), spans).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the four kinds, by kind in the order of ``KINDS``, then start; matches that fail their check are dropped."""
    def sound(kind: str) -> Column:
        return F.filter(located(text, FORMS[kind], SIGNS[kind], kind), lambda span: _passes(kind, span["found"]))

    return F.concat(*map(sound, KINDS))


def _head(token: Column) -> Column:
    """What a token has before its first ``=`` or ``:``, with this, if a value follows; else empty."""
    return F.regexp_extract(token["found"], HEAD, 1)


def seeds_of(tokens: Column, base: Column) -> Column:
    """Pattern and instance of the base spans, each in the slot of the token that it begins in.

    Its patterns are the word before the token, and the token's head if the span stands behind it. ``first`` marks one
    occurrence of each pattern and token, however many spans begin there.
    """
    def seeds(token: Column) -> Column:
        inside = F.filter(base, lambda b: (b["start"] >= token["start"]) & (b["start"] < token["end"]))
        behind = F.filter(inside, lambda b: b["start"] - token["start"] >= F.char_length(_head(token)))

        def slot(sign: str, name: Column, spans: Column) -> Column:
            pattern = F.concat(F.lit(sign), F.lower(name))
            held = F.transform(spans, lambda b, i: F.struct(pattern.alias("pattern"), F.lower(b["found"]).alias("instance"), (i == 0).alias("first")))
            return F.when(name != "", held).otherwise(F.array().cast(SEED))

        return F.concat(slot("w ", token["before"], inside), slot("h ", _head(token), behind))

    return F.when(F.size(base) > 0, F.flatten(F.transform(tokens, seeds))).otherwise(F.array().cast(SEED))


def _candidates(rows: DataFrame) -> DataFrame:
    """(id, mark, pattern, span) of the other tokens: as a whole after a word, and the value after a head."""
    token, head = F.col("token"), F.col("head")
    size = F.char_length(head)
    whole = F.struct(F.concat(F.lit("w "), F.lower(token["before"])).alias("pattern"), token["start"].alias("start"), token["end"].alias("end"), token["found"].alias("found"))
    value = F.struct(
        F.concat(F.lit("h "), F.lower(head)).alias("pattern"), (token["start"] + size).alias("start"), token["end"].alias("end"),
        F.substring(token["found"], size + 1, F.char_length(token["found"])).alias("found"),
    )
    slots = F.when(size > 0, F.array(whole, value)).otherwise(F.array(whole))
    tokens = rows.select("id", "mark", F.explode("others").alias("token")).withColumn("head", _head(token))
    spans = tokens.select("id", "mark", F.explode(slots).alias("span"))
    return spans.select("id", "mark", "span.pattern", F.col("span").dropFields("pattern").alias("span"))


def bootstrap(
    rows: DataFrame, words: DataFrame, scratch: Scratch, min_support: int = 3, min_precision: float = 0.5, rounds: int | None = None
) -> DataFrame:
    """(instance) of the identifiers that precise patterns discover.

    ``rows``: id, mark, seeds and others (spans). ``words``: (word) of every place in the corpus. A pattern's precision
    is the number of its occurrences with a known instance over all its occurrences; it needs ``min_support`` different
    known instances. Rounds go on until no instance is new, or for as many as ``rounds`` says.
    """
    seeds = rows.select(F.explode("seeds").alias("at")).select("at.pattern", "at.instance", F.lit(True).alias("seed"), F.col("at.first").cast("int").alias("times"))
    others = _candidates(rows).filter(F.length("pattern") > 2).select("pattern", F.lower("span.found").alias("instance"), F.lit(False).alias("seed"), F.lit(1).alias("times"))
    edges = scratch.store(
        seeds.unionByName(others).groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.sum("times").alias("times")), "edges"
    )
    # only patterns that seeds support can start; what they have in common with others comes in later rounds
    found = None
    totals = None
    while True:
        known = edges.filter("seed").select("instance") if found is None else edges.filter("seed").select("instance").union(found.select("instance"))
        held = edges.join(known.distinct(), "instance", "left_semi")
        support = held.groupBy("pattern").agg(F.count(F.lit(1)).alias("support"), F.sum("times").alias("hits")).filter(F.col("support") >= min_support)
        if totals is None:
            totals = _totals(edges, words, min_support, scratch)
        precise = support.join(totals, "pattern").filter(F.col("hits") >= min_precision * F.col("total")).select("pattern")
        reached = scratch.store(
            edges.filter("NOT seed").filter(F.col("instance").rlike("[0-9]") & (F.length("instance") >= 5)).join(precise, "pattern", "left_semi").select("instance").distinct(),
            "reached",
        )
        grown = reached.count() > (0 if found is None else found.count())
        found = reached
        rounds = None if rounds is None else rounds - 1
        if not grown or rounds == 0:
            return found


def _totals(edges: DataFrame, words: DataFrame, min_support: int, scratch: Scratch) -> DataFrame:
    """How often each pattern that could matter occurs: words anywhere in the corpus, heads in tokens that have them."""
    able = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"), F.sum("times").alias("times")).filter(F.col("instances") >= min_support)
    heads = able.filter(F.col("pattern").startswith("h ")).select("pattern", F.col("times").alias("total"))
    # a bitmap keeps words of no such pattern out of the shuffle; the join decides
    slots = scratch.store(able.filter(F.col("pattern").startswith("w ")).select(F.expr("substring(pattern, 3)").alias("word")), "slots")
    counts = words.filter(membership(slots, scratch)(F.col("word"))).groupBy("word").count().select(F.concat(F.lit("w "), "word").alias("pattern"), F.col("count").alias("total"))
    return scratch.store(heads.unionByName(counts.join(able.select("pattern"), "pattern", "left_semi")), "totals")


def find_pii(
    docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", min_support: int = 3, min_precision: float = 0.5, rounds: int | None = None
) -> DataFrame:
    """Spans of personal data in every whole text; one row per row of ``docs``.

    Returns ``id_col`` and ``spans``: kind, start, end (code points, end exclusive), found; by kind (email, ip, card,
    phone, learned), then start. ``learned`` spans are tokens with a digit, or their values behind ``=`` or ``:``, that the
    bootstrap discovered; they never overlap each other or the rest. Null and empty texts have none. Repeated rows have the same spans; null ids are returned as they
    are; an empty table gives no rows. Texts are read twice and never shuffled; patterns and instances are counted
    before they are shuffled.
    """
    content = body(text_col)
    rows = docs.select(col(id_col).alias("id"), content.alias("content"))
    located_base = rows.select("id", F.xxhash64("content").alias("mark"), base_spans(F.col("content")).alias("base"), located(F.col("content"), TOKEN, r"[0-9@=]", "learned", words=True).alias("tokens"))
    apart = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    found = scratch.store(located_base.select("id", "mark", "base", apart.alias("others"), seeds_of(F.col("tokens"), F.col("base")).alias("seeds")), "found")
    words = rows.select(F.explode(F.split(F.lower("content"), BLANKS)).alias("word")).filter("word <> ''")
    instances = bootstrap(found, words, scratch, min_support, min_precision, rounds)
    # where a token and its value are known, the token is one span
    discovered = (
        _candidates(found).join(instances, F.lower("span.found") == F.col("instance"))
        .groupBy(F.col("id").alias("of"), F.col("mark").alias("with"), "span.end")
        .agg(F.min(F.struct(F.lit("learned").alias("kind"), F.col("span.start").alias("start"), F.col("span.end").alias("end"), F.col("span.found").alias("found"))).alias("span"))
        .groupBy("of", "with").agg(F.collect_list("span").alias("learned"))
    )
    shown = lambda spans: F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found")))
    learned = F.array_sort(F.coalesce("learned", shown(F.array().cast(SPAN))))
    return found.join(discovered, F.col("id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("with")), "left").select(
        F.col("id").alias(id_col), F.concat(shown(F.col("base")), learned).alias("spans")
    )


def joined_spans(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(kind: str, spans: Column) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
