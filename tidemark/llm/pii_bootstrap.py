"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base rules find e-mail addresses, IP numbers, card numbers and phone numbers.
They are the seeds of a bipartite graph between *instances* (strings that hold a
digit or an @, such as ``(988) 555-2485``) and lexical *patterns* of their
occurrences: the whole shape, the shape's end, the word before with a coarse
shape.  Each round scores a pattern, per kind, by its known instances against
those that contradict the kind: known ones of another kind, and unknown ones
that fail the kind's own check (digits, Luhn, octets, @).  Other unknown
instances are neutral, however many.  An instance is scored by the confident
patterns it occurs in; instances above the threshold count as known in the next
round.  Occurrences of accepted instances outside the base spans are the added
spans.

The scan writes one narrow table (spans and candidates per document); the graph
is aggregated per (pattern, instance) before any join, so a common pattern is a
sum, not a group.  Added spans belong to a text, not to an id: they return to the
rows by the text's key.

Cases: a null text is an empty one and has no spans; every row gets the spans of its
own text, also where ids repeat or are null; a run of numbers longer than any identifier is split into its numbers;
other candidates longer than ``LONGEST`` code points are no identifiers;
without seeds nothing is added; extra columns pass through ``masked``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import keep, text_key

# The kinds in their order, and the base patterns.  A run of local-part characters or digits can only
# match from its start (or from the end of the match before), which keeps long runs linear.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

SPACE = r"\x20\x09-\x0D"
# A number phrase, or a word that holds a digit or an @.
CANDIDATE = (rf"(?<![^{SPACE}])(?:[+(]*+[0-9][0-9().+\x20-]*[0-9](?![^{SPACE}.,;:!?)])"
             rf"|[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+)")
LONGEST = 128
# A run of numbers with more digits than any kind has holds several: a whole international number, a number with its
# area code in brackets, or a word.
MOST_DIGITS = 19
NUMBERS = r"[0-9().+\x20-]++"
NUMBER = (r"\+[0-9](?:[().\x20-]*+[0-9]){8,14}+(?![().\x20-]*+[0-9])"
          r"|(?:\+[0-9]{1,3}[\x20.-]?|1[\x20.-])?\([0-9]++\)[\x20.-]*+[0-9]++(?:[.-][0-9]++)*+"
          r"|\+?[0-9]++(?:[().+-]++[0-9]++)*+")

ROUNDS = 3
CONFIDENT = 0.9  # least pattern confidence (known against contradicting instances), and least instance score to be accepted
SUPPORT = 5  # least known instances of a confident pattern

_SPANS = "array<struct<start:int,end:int,hit:string>>"


def _spans(text: Column, pattern: str) -> Column:
    """(start, end, hit) of the leftmost non-overlapping matches, in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    # zip_with computes either side once; a look-up inside a lambda would cut the text anew for every match.
    pairs = F.filter(F.zip_with(hits, gaps, lambda h, g: F.struct(g.alias("gap"), h.alias("hit"))), lambda x: x["hit"].isNotNull())
    return _let(pairs, _placed)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _placed(pairs: Column) -> Column:
    """Spans from (gap, hit) pairs.

    An array that grows match by match is copied with every match, so the matches are placed in blocks of about the
    square root of their number, and the blocks one behind the other.
    """
    block = F.ceil(F.sqrt(F.size(pairs))).cast("int")
    state = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["hit"].alias("hit")))).alias("out"))

    def of_block(first: Column) -> Column:
        return F.aggregate(F.slice(pairs, first, block), state, step)

    def shifted(blocks: Column) -> Column:
        begins = F.aggregate(
            blocks, F.array(F.lit(0)), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + b["at"])))
        return _let(begins, lambda at: F.flatten(F.transform(blocks, lambda b, i: F.transform(b["out"], lambda s: F.struct(
            (s["start"] + F.get(at, i)).alias("start"), (s["end"] + F.get(at, i)).alias("end"), s["hit"].alias("hit"))))))

    blocks = F.transform(F.sequence(F.lit(1), F.size(pairs), F.greatest(block, F.lit(1))), of_block)
    return F.when(F.size(pairs) > 0, _let(blocks, shifted)).otherwise(F.array().cast(_SPANS))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(x: Column, i: Column) -> Column:
        d = x.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    places = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda x: x != ""), value)
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def _octet(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?=.)", "")
    return (F.char_length(short) <= 3) & (F.substring(short, 1, 3).cast("int") <= 255)


def base_spans(text: Column) -> Column:
    """Array of (kind number, start, end, hit) by kind and start."""
    none = F.array().cast(_SPANS)
    digit = F.regexp_like(text, F.lit("[0-9]"))
    found = (
        F.when(F.contains(text, F.lit("@")), _spans(text, EMAIL)).otherwise(none),
        F.when(digit, F.filter(_spans(text, IP), lambda s: F.forall(F.split(s["hit"], r"\."), _octet))).otherwise(none),
        F.when(digit, F.filter(_spans(text, CARD), lambda s: F.char_length(_digits(s["hit"])).between(13, 19)
                               & _luhn(_digits(s["hit"])))).otherwise(none),
        F.when(F.contains(text, F.lit("+")), F.filter(
            _spans(text, PHONE), lambda s: F.char_length(_digits(s["hit"])).between(9, 15))).otherwise(none),
    )
    return F.concat(*[_tagged(spans, k) for k, spans in enumerate(found)])


def _tagged(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"], s["end"], s["hit"]))


def of_kind(spans: Column, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _trimmed(s: Column) -> Column:
    """A candidate without the punctuation around it."""
    opening = r"^[\"'\[<{]+|^\((?![0-9]+\))"
    hit = F.regexp_replace(s["hit"], opening, "")
    start = s["end"] - F.char_length(hit)
    hit = F.regexp_replace(hit, r"(?<![\"'.,;:!?\]>}])[\"'.,;:!?\]>}]+$", "")
    return F.struct(start.alias("start"), (start + F.char_length(hit)).alias("end"), hit.alias("hit"))


def _numbers(s: Column) -> Column:
    """A candidate, or the numbers of a run that is too long for one."""
    size = F.char_length(s["hit"])
    many = (size > MOST_DIGITS) & F.regexp_like(s["hit"], F.lit(f"^{NUMBERS}$")) & (
        (size > LONGEST) | (F.char_length(_digits(s["hit"])) > MOST_DIGITS))
    return F.when(many, F.transform(_spans(s["hit"], NUMBER), lambda x: F.struct(
        (s["start"] + x["start"]).alias("start"), (s["start"] + x["end"]).alias("end"), x["hit"].alias("hit"))))\
        .otherwise(F.array(s))


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text key, base spans and candidates (with the word before) of every document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t"), *text_key(F.col(text_col))).select(
        "id", "h1", "h2", "t", base_spans(F.col("t")).alias("base"))
    before = lambda s: F.regexp_extract(F.substring(F.col("t"), F.greatest(s["start"] - 63, F.lit(1)),
                                                    F.least(s["start"], F.lit(64))),
                                        rf"([^{SPACE}]++)[{SPACE}]*+$", 1)
    raw = F.transform(F.filter(F.flatten(F.transform(_spans(F.col("t"), CANDIDATE), _numbers)),
                               lambda s: s["end"] - s["start"] <= LONGEST), _trimmed)
    free = F.transform(raw, lambda s: F.struct(
        s["start"], s["end"], s["hit"], F.lower(before(s)).alias("before"),
        F.get(F.filter(F.transform(F.col("base"), lambda b: F.when(
            (b["start"] == s["start"]) & (b["end"] == s["end"]), b["kind"])), lambda k: k.isNotNull()), F.lit(0)).alias(
            "seed"),
        F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])).alias("taken")))
    none = F.array().cast("array<struct<start:int,end:int,hit:string,before:string,seed:int,taken:boolean>>")
    return rows.select("id", "h1", "h2", "base", F.when(F.regexp_like("t", F.lit("[0-9@]")), free).otherwise(none).alias("cand"))


def _shape(hit: Column) -> Column:
    """Letters become a, other scripts u, digit runs d and their length; long digit runs stay apart by length."""
    s = F.regexp_replace(F.regexp_replace(hit, "[^\\x00-\\x7F]+", "µ"), "[A-Za-z]+", "a")
    runs = F.regexp_extract_all(s, F.lit("[0-9]+|[^0-9]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.when(
        r.rlike("^[0-9]"), F.concat(F.lit("d"), F.char_length(r).cast("string"))).otherwise(r)), "")


def _patterns(hit: Column, before: Column) -> Column:
    shape = _shape(hit)
    end = F.regexp_extract(shape, r"(\(?[ad][0-9]*[^ad0-9]+[ad][0-9]*)$", 1)
    return F.filter(F.array(
        F.concat(F.lit("shape "), shape),
        F.when(end != "", F.concat(F.lit("end "), end)),
        F.when(before != "", F.concat(F.lit("after "), before, F.lit(" "), F.regexp_replace(shape, "[0-9]+", "")))),
        lambda p: p.isNotNull())


def _fits(hit: Column) -> Column:
    """Array by kind: whether the instance passes the kind's own check, whatever its form."""
    digits, letters = _digits(hit), F.regexp_like(hit, F.lit("[A-Za-z]"))
    octets = F.regexp_extract_all(hit, F.lit("[0-9]+"), F.lit(0))
    return F.array(
        F.regexp_like(hit, F.lit("[^@]@[^@]")),
        ~letters & (F.size(octets) == 4) & F.forall(octets, _octet),
        F.when(letters | ~F.char_length(digits).between(13, 19), False).otherwise(_luhn(digits)),
        ~letters & F.char_length(digits).between(9, 15))


def bootstrap(scan: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT, support: int = SUPPORT) -> DataFrame:
    """(hit, kind, score) of the accepted instances that are no seeds, from the scan's candidates."""
    occ = scan.select(F.explode("cand").alias("c")).select("c.*").where("seed IS NOT NULL OR NOT taken")
    edges = keep(occ.select(F.explode(_patterns(F.col("hit"), F.col("before"))).alias("pattern"), "hit", "seed")
                 .groupBy("pattern", "hit").agg(F.min("seed").alias("seed")).withColumn("fits", _fits(F.col("hit"))),
                 "pii_edges")
    seeds = edges.where("seed IS NOT NULL").groupBy("hit").agg(F.min("seed").alias("kind")).withColumn(
        "score", F.lit(1.0))
    known = seeds
    for r in range(rounds):
        good = _confident(edges, known, confident, support)
        # An instance is the noisy-or of its confident patterns.
        scored = (edges.where("seed IS NULL").select("pattern", "hit").join(good, "pattern").groupBy("hit", "kind")
                  .agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("conf"), F.lit(0.999)))))).alias("score")))
        best = (scored.groupBy("hit").agg(F.max(F.struct("score", (-F.col("kind")).alias("minus"))).alias("b"))
                .select("hit", (-F.col("b.minus")).alias("kind"), F.col("b.score").alias("score"))
                .where(F.col("score") >= confident))
        found = keep(best, f"pii_round_{r}")
        known = seeds.unionByName(found.join(seeds, "hit", "left_anti"))
    return found if rounds else seeds.limit(0)


def _confident(edges: DataFrame, known: DataFrame, confident: float, support: int) -> DataFrame:
    """(pattern, kind, conf) of the patterns whose known instances of a kind outweigh those that contradict it."""
    kinds = range(len(KINDS))
    of = edges.select("pattern", "hit", "fits").join(known, "hit", "left")
    per = of.groupBy("pattern").agg(F.array(*[F.struct(
        F.lit(k).alias("kind"),
        F.sum(F.when(F.col("kind") == k, F.col("score"))).alias("w"),
        F.count(F.when(F.col("kind") == k, 1)).alias("k"),
        F.count(F.when(F.coalesce(F.col("kind") != k, ~F.col("fits")[k]), 1)).alias("against")) for k in kinds]).alias(
            "s"))
    return (per.select("pattern", F.explode("s").alias("s")).select("pattern", "s.*")
            .withColumn("conf", F.col("w") / (F.col("w") + F.col("against") + 0.5))
            .where((F.col("conf") >= confident) & (F.col("k") >= support)).select("pattern", "kind", "conf"))


def _added(scan: DataFrame) -> DataFrame:
    """(h1, h2, added): the occurrences of accepted instances outside the base spans, per text."""
    new = bootstrap(scan)
    return (scan.select("h1", "h2", F.explode("cand").alias("c")).where("NOT c.taken")
            .select("h1", "h2", "c.start", "c.end", "c.hit").distinct()  # copies of a text become one
            .join(new.select("hit", "kind"), "hit").groupBy("h1", "h2")
            .agg(F.collect_set(F.struct("kind", "start", "end")).alias("added")))


def _places(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"]))


def _all_spans(base: Column) -> Column:
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return F.array_sort(F.concat(base, F.coalesce(F.col("added"), none)))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``base`` and ``spans``, arrays of (kind number, start, end) by kind and start."""
    scan = keep(_scan(docs, id_col, text_col), "pii_scan")
    return scan.select("id", "h1", "h2", _places(F.col("base")).alias("base")).join(_added(scan), ["h1", "h2"], "left").select(
        F.col("id").alias(id_col), "base", _all_spans(F.col("base")).alias("spans"))


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by the kind in brackets.

    Base spans are found again where the text lies; documents are shuffled only if there are added spans.
    """
    added = keep(_added(keep(_scan(docs, id_col, text_col), "pii_scan")), "pii_added")
    if added.isEmpty():
        spans = F.array_sort(_places(base_spans(F.col(text_col))))
        return docs.withColumn(text_col, F.when(F.col(text_col).isNotNull(), mask(F.col(text_col), spans)))
    whole = docs.select(F.struct(*docs.columns).alias("doc"), *text_key(F.col(text_col)))
    rows = whole.join(added, ["h1", "h2"], "left")
    text = F.col(f"doc.{text_col}")
    spans = _all_spans(_places(base_spans(text)))
    done = F.when(text.isNotNull(), mask(text, spans))
    return rows.select(*[done.alias(c) if c == text_col else F.col(f"doc.{c}") for c in docs.columns])


def render(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, of the first kind."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    empty = F.array().cast("array<struct<start:int,end:int,kind:int>>")

    def merge(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        joined = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
            last["start"], F.greatest(last["end"], s["end"]).alias("end"), last["kind"])))
        return F.when(F.coalesce(last["end"] > s["start"], F.lit(False)), joined).otherwise(
            F.concat(acc, F.array(s)))

    merged = F.aggregate(ordered, empty, merge)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(merged, state, lambda acc, s: F.struct(
        s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                                       F.element_at(names, s["kind"] + 1)).alias("out")))
    return F.when(F.size(spans) > 0, F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text))))\
        .otherwise(text)
