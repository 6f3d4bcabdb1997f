"""Personal data in texts: fixed patterns, and identifiers that bootstrapped contexts reveal.

Only DataFrame operations. One pass over the texts finds the spans of four kinds and all other mentions
that look like identifiers, each with the word before and after it. From then on only these small rows
move: spans of fixed patterns are seeds, the words around mentions are lexical patterns. Patterns are
scored by the share of their instances that belong to a kind, other instances by the patterns that
hold them, in turns; mentions with a high score become spans as well.

A pattern or instance may be very frequent: counts combine before the shuffle, joins are on keys
that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlayers.llm.common import stored, table

KINDS = ("email", "ip", "card", "phone")
# Same matches as the plain patterns, without retries inside a run of characters that cannot match:
# a match begins where a run does, or where the last match ended.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Other mentions: at least six characters of identifiers, four digits or an @ among them.
_IDENTIFIER = "[A-Za-z0-9@._+()-]"
MENTION = (
    rf"(?:(?<!{_IDENTIFIER})|\G)(?=(?:[A-Za-z@._+()-]*+[0-9]){{4}}|[A-Za-z0-9._+()-]*+@){_IDENTIFIER}{{6,}}+"
)
ROUNDS = 3
#: A pattern counts from this confidence, and from so many instances of the kind.
LEAST_CONFIDENCE, LEAST_SUPPORT = 0.8, 4
LEAST_SCORE = 0.9
CONTEXT = 64
#: Values whose sums are told one after another, and code points of a piece of text that is cut.
RUN, PIECE = 200, 1000


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum of card numbers."""
    back = F.reverse(digits)
    place = F.sequence(F.lit(1), F.length(digits))

    def weighted(i: Column) -> Column:
        digit = F.substring(back, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(place, F.lit(0), lambda total, i: total + weighted(i)) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "card": F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False),
        "phone": F.length(digits).between(9, 15),
    }[kind]


def _bound(value: Column, function) -> Column:
    """function(value), with the value computed once however often the function names it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def _before(values: Column, combine) -> Column:
    """What `combine` makes of 0 and all integers before each one of `values`.

    An array grows by copying it, so the values are taken in runs of RUN, and the runs are put together.
    """
    none = F.expr("cast(array() as array<int>)")

    def scan(own: Column, begin: Column) -> Column:
        def step(seen: Column, value: Column) -> Column:
            return F.struct(combine(seen.at, value).alias("at"), F.concat(seen.out, F.array(seen.at)).alias("out"))

        return F.aggregate(own, F.struct(begin.alias("at"), none.alias("out")), step, lambda seen: seen.out)

    last = F.floor((F.size(values) - 1) / RUN).cast("int")
    runs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda r: F.slice(values, r * RUN + 1, F.lit(RUN)))

    def joined(of: Column) -> Column:
        whole = F.transform(of, lambda run: F.aggregate(run, F.lit(0), combine))
        return F.flatten(F.zip_with(of, scan(whole, F.lit(0)), scan))

    return _bound(runs, joined)


def _matches(text: Column, pattern: str, hint: Column, around: bool = False) -> Column:
    """All matches with first and last-plus-one code point; `around`: and the text before and after each."""
    fields = "start:int,end:int,value:string" + (",before:string,after:string" if around else "")

    def placed(parts: Column) -> Column:
        gaps = F.slice(parts.gaps, F.lit(1), F.size(parts.found))
        steps = F.zip_with(gaps, parts.found, lambda gap, value: F.length(gap) + F.length(value))

        def match(at: Column, i: Column) -> Column:
            gap, value = F.get(parts.gaps, i), F.get(parts.found, i)
            start = at + F.length(gap)
            columns = [start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value")]
            if around:
                columns.append(F.right(gap, F.lit(CONTEXT)).alias("before"))
                columns.append(F.left(F.get(parts.gaps, i + 1), F.lit(CONTEXT)).alias("after"))
            return F.struct(*columns)

        return F.transform(_bound(steps, lambda own: _before(own, lambda a, b: a + b)), match)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    parts = F.struct(found, F.split(text, pattern, -1).alias("gaps"))
    return F.when(hint, _bound(parts, placed)).otherwise(F.expr(f"cast(array() as array<struct<{fields}>>)"))


def _spans(text: Column) -> Column:
    """Spans (start, kind, end, value) of the fixed patterns, in order of start, then kind."""
    some_digit = text.rlike("[0-9]")
    hints = {"email": text.contains("@"), "ip": some_digit, "card": some_digit, "phone": text.contains("+")}
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}

    def of_kind(kind: str) -> Column:
        number = F.lit(KINDS.index(kind)).alias("kind")
        matches = F.filter(_matches(text, patterns[kind], hints[kind]), lambda m: _valid(kind, m.value))
        return F.transform(
            matches, lambda m: F.struct(m.start.alias("start"), number, m.end.alias("end"), m.value.alias("value"))
        )

    return F.sort_array(F.concat(*[of_kind(kind) for kind in KINDS]))


def _first_after(spans: Column, at: Column) -> Column:
    """Of disjoint spans in order the first that ends after `at`, or null; found by halving."""

    def halve(seen: Column, _: Column) -> Column:
        middle = F.shiftright(seen.low + seen.high, 1)
        later = (seen.low < seen.high) & (F.get(spans, middle).end <= at)
        return F.struct(
            F.when(later, middle + 1).otherwise(seen.low).alias("low"),
            F.when(later, seen.high).otherwise(middle).alias("high"),
        )

    begin = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))
    halvings = F.sequence(F.lit(1), F.length(F.bin(F.size(spans))))
    return F.get(spans, F.aggregate(halvings, begin, halve, lambda seen: seen.low))


def _mentions(text: Column) -> Column:
    """Mentions with the words around them; `kind` is that of the base span it is, or null.

    Needs a column `spans`; mentions that only overlap one are left out. Spans of a kind are disjoint, so
    the first that ends after a mention's start tells whether any of the kind overlaps it.
    """
    either = "|".join((EMAIL, PHONE, IP, CARD, MENTION))
    matches = _matches(text, either, text.rlike("[0-9@]"), around=True)

    def touching(m: Column, by_kind: Column) -> Column:
        near = [_bound(F.get(by_kind, F.lit(k)), lambda own: _first_after(own, m.start)) for k in range(len(KINDS))]
        return F.filter(F.array(*near), lambda s: s.start < m.end)

    def described(m: Column, touched: Column) -> Column:
        return F.struct(
            m.start.alias("start"),
            m.end.alias("end"),
            F.lower(m.value).alias("instance"),
            F.get(F.transform(touched, lambda s: s.kind), F.lit(0)).alias("kind"),
            F.regexp_extract(F.lower(m.before), r"(\S+)\s*$", 1).alias("left"),
            F.regexp_extract(F.lower(m.after), r"^\s*(\S+)", 1).alias("right"),
            F.exists(touched, lambda s: (s.start != m.start) | (s.end != m.end)).alias("overlaps"),
        )

    def listed(by_kind: Column) -> Column:
        return F.transform(matches, lambda m: _bound(touching(m, by_kind), lambda touched: described(m, touched)))

    def of_kind(k: int) -> Column:
        return F.filter("spans", lambda s: s.kind == k)

    spans = F.array(*[of_kind(k) for k in range(len(KINDS))])
    return F.filter(_bound(spans, listed), lambda m: ~m.overlaps)


def _patterns() -> Column:
    """Lexical patterns of a mention: the word before, the word after, both."""
    left, right = F.col("left"), F.col("right")
    both = F.array(
        F.when(left != "", F.concat(F.lit("before "), left)),
        F.when(right != "", F.concat(F.lit("after "), right)),
        F.when((left != "") & (right != ""), F.concat(F.lit("between "), left, F.lit(" "), right)),
    )
    return F.array_compact(both)


def _shape_fits(kind: Column, instance: Column) -> Column:
    digits = F.length(_digits(instance))
    return (
        F.when(kind == 0, instance.contains("@"))
        .when(kind == 1, instance.rlike(r"[0-9][.][0-9]"))
        .when(kind == 2, digits.between(12, 19))
        .otherwise(digits.between(7, 15))
    )


def discovered(mentions: DataFrame) -> DataFrame:
    """(instance, kind) of identifiers that high-confidence patterns reveal.

    `mentions` has instance, kind (null unless a fixed pattern found it), left and right.
    """
    edges = stored(
        mentions.select("instance", F.explode(_patterns()).alias("pattern")).groupBy("pattern", "instance").agg(
            F.count("*").alias("times")
        )
    )
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("instances"))
    seeds = stored(mentions.where(F.col("kind").isNotNull()).groupBy("instance", "kind").agg(F.lit(1.0).alias("score")))
    scores = seeds
    for _ in range(ROUNDS):
        support = edges.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("support"))
        confidence = F.round(F.col("support") / (F.col("instances") + 1), 9)
        trusted = (
            support.where(F.col("support") >= LEAST_SUPPORT)
            .join(sizes, "pattern")
            .select("pattern", "kind", confidence.alias("confidence"))
            .where(F.col("confidence") >= LEAST_CONFIDENCE)
        )
        others = edges.join(trusted, "pattern").join(seeds.select("instance").distinct(), "instance", "left_anti")
        found = others.groupBy("instance", "kind").agg(
            F.round(1 - F.exp(F.sum(F.log1p(-F.col("confidence")))), 9).alias("score")
        )
        scores = stored(seeds.unionByName(found))
    new = scores.join(seeds.select("instance").distinct(), "instance", "left_anti")
    best = new.where((F.col("score") >= LEAST_SCORE) & _shape_fits(F.col("kind"), F.col("instance")))
    return best.groupBy("instance").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))


def detect(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """`docs` with `spans` (base) and `added`: arrays of (start, kind, end, value), in order.

    Positions are code points, the end exclusive; kind is a place in KINDS. A null text is empty. The
    rows of `docs` are all kept, repeated ones too; columns named `spans` and `added` are replaced,
    all others kept. `keep_text=False` drops the text early, so that it is never stored.
    """
    kept = docs.drop("spans", "added")
    text = F.coalesce("text", F.lit(""))
    columns = [c for c in kept.columns if keep_text or c != "text"]
    # the document's columns are held in one, so that their names meet no other
    read = kept.select("text", F.struct(*columns).alias("document")).withColumn("spans", _spans(text))
    read = read.select("document", "spans", _mentions(text).alias("mentions"))
    first = stored(read.withColumn("row", F.monotonically_increasing_id()))
    mentions = first.where(F.size("mentions") > 0).select("row", F.inline("mentions"))
    fresh = stored(mentions.where(F.col("kind").isNull()).drop("kind").join(discovered(mentions), "instance"))
    span = F.struct("start", "kind", "end", F.col("instance").alias("value"))
    per_row = fresh.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("added"))
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int,value:string>>)")
    without = first.where(F.size("mentions") == 0).select("document.*", "spans", none.alias("added"))
    having = first.where(F.size("mentions") > 0).join(per_row, "row", "left")
    return having.select("document.*", "spans", F.coalesce("added", none).alias("added")).unionByName(without)


def redacted(text: Column, spans: Column) -> Column:
    """`text` with each span replaced by its kind in brackets; overlapping spans by the first one's.

    The text is cut into pieces first, so that a span costs a piece and not the whole text.
    """
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])

    def part(pieces: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        own = F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1)

        def cut(piece: Column, i: Column) -> Column:
            begin = F.greatest(start - (first + i) * PIECE, F.lit(0))
            return F.substring(piece, begin + 1, F.least(end - (first + i) * PIECE, F.lit(PIECE)) - begin)

        return F.array_join(F.transform(own, cut), "")

    def put_together(held: Column) -> Column:
        def replaced(s: Column, i: Column) -> Column:
            at = F.get(held.done, i)
            return F.when(
                s.start >= at, F.concat(part(held.pieces, at, s.start), F.element_at(names, s.kind + 1))
            ).otherwise("")

        last = part(held.pieces, F.array_max(held.ends), F.length(text))
        return F.concat(F.array_join(F.transform(held.spans, replaced), ""), last)

    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    ends = F.transform(spans, lambda s: s.end)
    held = _bound(
        F.struct(spans.alias("spans"), ends.alias("ends"), pieces.alias("pieces")),
        lambda h: F.struct(
            h.spans.alias("spans"), h.ends.alias("ends"), h.pieces.alias("pieces"), _before(h.ends, lambda a, b: F.greatest(a, b)).alias("done")
        ),
    )
    return F.when(F.size(spans) > 0, _bound(held, put_together)).otherwise(text)


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start, s.end)), ","
    )


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = detect(table(spark, folder, "documents").select("doc_id", "text"), keep_text=False)

    def count(kind: str) -> Column:
        of_kind = F.filter("spans", lambda s: s.kind == KINDS.index(kind))
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    every = F.sort_array(F.concat("spans", "added"))
    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(listed(F.col("spans")), 256).alias("base_sha256"),
        listed(every).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
