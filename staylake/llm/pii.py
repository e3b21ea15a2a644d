"""Personal data: base patterns and bootstrapped contextual extraction.

Base matches of four kinds seed the bootstrap.  A lexical pattern is the word
before or after a mention.  In every round Spark scores the graph of patterns
and instances: a pattern's confidence in a kind is the share of known values of
that kind among all distinct values it occurs with; an instance's score
combines the confidences of the patterns it occurs with (noisy or).  Instances
of a fitting shape above ``min_score`` become known and take part in the next
round, until a round finds none.  Their mentions are added to the base spans.

DataFrame functions only.  The texts are read once; what is kept per document
is its mentions.  Matching is linear in the text's length: the expressions
below accept what the base patterns accept, without their backtracking.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import stored

KINDS = ["email", "ip", "card", "phone"]
EXPRESSIONS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A word with a digit or an @, and the space after it.
LOOSE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+\x20?"
# A word that a looser number of several words could begin with.
NUMBER = r"^[\"'<\[,;:=]*[+(]?[0-9][0-9()/.-]*$"
RUN_WORDS = 19  # words of the longest shape below: every word holds a digit
CONTEXT_CHARS = 48
RUN_MATCHES = 256
PIECE_CHARS = 256
MIN_SUPPORT = 10
MIN_CONFIDENCE = 0.9
MIN_SCORE = 0.9
SPAN = "array<struct<start:int,end:int,kind:string,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.try_to_number(F.substr(digits, -i, F.lit(1)), F.lit("9")).cast("int")
        return total + F.when(i % 2 == 0, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (
            F.length(F.ltrim(p, F.lit("0"))) <= 3)
            & (F.concat(F.lit("0"), F.right(p, F.lit(3))).cast("int") <= 255))
    if kind == "card":
        digits = F.translate(value, " -", "")
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _folded(n: Column, nothing: Column, step) -> Column:
    """(at, out): ``step(state, i)`` gives the next ``at`` and an entry of ``out``
    for every i below ``n``, which is at least 1."""
    def append(state, i):
        at, entry = step(state, i)
        return F.struct(at.cast("int").alias("at"),
                        F.array_append(state["out"], entry).alias("out"))

    def chunk(state, c):
        """Entries of one run: appending copies, so runs are short."""
        run = F.aggregate(
            F.sequence(c * RUN_MATCHES, F.least((c + 1) * RUN_MATCHES, n) - 1),
            F.struct(state["at"].alias("at"), nothing.alias("out")), append)
        return F.transform(F.array(run), lambda r: F.struct(
            r["at"].alias("at"), F.concat(state["out"], r["out"]).alias("out")))[0]

    return F.aggregate(F.sequence(F.lit(0), F.floor((n - 1) / RUN_MATCHES).cast("int")),
                       F.struct(F.lit(0).alias("at"), nothing.alias("out")), chunk)


def _pieces(text: str) -> Column:
    """The text in pieces of PIECE_CHARS code points: a span of a long text is
    cut from the pieces it lies in, not looked up from the text's start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))


def _cut(start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of the text behind the column ``_pieces``."""
    first = F.floor(start / PIECE_CHARS).cast("int")
    held = F.slice("_pieces", first + 1, F.floor((end - 1) / PIECE_CHARS).cast("int") - first + 1)
    return F.substr(F.array_join(held, ""), start - first * PIECE_CHARS + 1, end - start)


def _masked() -> Column:
    """The text with base matches as line breaks, which part words and keep
    every offset."""
    def step(state, i):
        s = F.get(F.col("_sorted"), i)
        end = F.greatest(s["end"], state["at"])
        gap = F.when(s["start"] > state["at"], _cut(state["at"], s["start"])).otherwise("")
        return end, F.concat(gap, F.repeat(
            F.lit("\n"), end - F.greatest(s["start"], state["at"])))

    done = _folded(F.size("_sorted"), F.array().cast("array<string>"), step)
    # An array of one element binds what is folded once per text.
    return F.when(F.size("_sorted") > 0, F.transform(F.array(done), lambda d: F.concat(
        F.array_join(d["out"], ""), F.when(d["at"] < F.length("text"), _cut(
            d["at"], F.length("text"))).otherwise("")))[0]).otherwise(F.col("text"))


def _matches(df: DataFrame, name: str, pattern: str, hint: Column) -> DataFrame:
    """Adds ``name``: array<struct<start,end,value>> of all matches."""
    found, parts = f"_{name}_found", f"_{name}_parts"
    none = F.array().cast("array<string>")
    df = df.withColumn(found, F.when(hint, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
                       .otherwise(none))
    df = df.withColumn(parts, F.when(F.size(found) > 0, F.split("text", pattern, -1))
                       .otherwise(none))

    def step(state, i):
        start = state["at"] + F.length(F.get(F.col(parts), i))
        end = start + F.length(F.get(F.col(found), i))
        return end, F.struct(start.alias("start"), end.alias("end"),
                             F.get(F.col(found), i).alias("value"))

    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")
    spans = F.when(F.size(found) > 0, _folded(F.size(found), nothing, step)["out"]).otherwise(nothing)
    return df.withColumn(name, spans).drop(found, parts)


def base_spans(df: DataFrame) -> DataFrame:
    """Adds ``base``: valid base matches by kind of the column ``text``."""
    hints = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+")),
             "ip": F.contains("text", F.lit(".")), "card": F.lit(True)}
    for kind in KINDS:
        df = _matches(df, f"_{kind}", EXPRESSIONS[kind], hints[kind])

    def checked(kind):
        return F.transform(
            F.filter(f"_{kind}", lambda s: _valid(kind, s["value"])),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                               F.lit(kind).alias("kind"), s["value"].alias("value")))

    valid = [checked(kind) for kind in KINDS]
    return df.withColumn("base", F.concat(*valid).cast(SPAN)).drop(*[f"_{k}" for k in KINDS])


def _shapes(value: Column) -> Column:
    """The kinds a loose value could be."""
    digits = F.length(_digits(value))
    return F.filter(F.array(
        F.when(value.rlike(r"^[^\s@]{1,64}@[^\s@]{1,255}$"), F.lit("email")),
        F.when(value.rlike(r"^[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}$"), F.lit("ip")),
        F.when(value.rlike(r"^[0-9][0-9 /.-]{0,40}$") & digits.between(12, 19), F.lit("card")),
        F.when(value.rlike(r"^[+(]?[0-9][0-9 ()/.-]{0,40}$") & digits.between(7, 15),
               F.lit("phone"))), lambda k: k.isNotNull())


def _word(context: Column, pattern: str) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(context, pattern, 1)), "[0-9]", "0")


def _with_context(spans: str, extra) -> Column:
    """Spans of an array column with the words around them."""
    def one(s):
        before = _cut(F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)), s["start"])
        after = _cut(s["end"], s["end"] + CONTEXT_CHARS)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), *extra(s),
                        s["value"].alias("value"),
                        _word(before, r"(\S{1,40})\s*$").alias("left"),
                        _word(after, r"^\s*(\S{1,40})").alias("right"))

    return F.transform(spans, one)


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, base, loose) per row: spans with the words around them.

    ``loose`` holds what looks like an identifier of some kind between the base
    matches, without punctuation at its ends: words with a digit or an @, and
    all runs of them parted by single spaces.  ``first`` and ``last`` are hashes
    of the words from its start on and up to its end: candidates that share
    them stand at one place.
    """
    df = docs.select(F.col(id_col).alias("id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    df = base_spans(df)
    df = df.withColumn("_sorted", F.array_sort("base")).withColumn("_pieces", _pieces("text"))
    df = df.withColumn("_masked", _masked()).drop("_sorted")
    df = df.withColumn("_text", F.col("text")).withColumn("text", F.col("_masked")).drop("_masked")
    df = _matches(df, "_words", LOOSE, F.lit(True))
    df = df.withColumn("text", F.col("_text")).drop("_text")
    word = lambda n: F.get(F.col("_words"), n)

    def joined(n):
        """Whether word ``n`` and the next one are parted by one space."""
        return F.coalesce(word(n)["end"] == word(n + 1)["start"], F.lit(False)) \
            & word(n)["value"].endswith(" ")

    def reach(i, way):
        """Words of the run from word ``i`` on, or back from it."""
        return F.aggregate(F.sequence(F.lit(1), F.lit(RUN_WORDS - 1)), F.lit(1), lambda n, k: F.when(
            (n == k) & (i + way * k >= 0) & joined(i + k - 1 if way > 0 else i - k), n + 1)
            .otherwise(n))

    def joint(i, n):
        return F.rtrim(F.array_join(F.transform(
            F.slice(F.col("_words"), i + 1, n), lambda w: w["value"]), ""))

    def candidate(i, n, first):
        run = joint(i, n)
        lead = F.length(F.regexp_extract(run, r"^[\"'<\[,;:=]*", 0))
        value = F.regexp_replace(F.substr(run, lead + 1), r"[\"'>\],;:.!?]+$", "")
        start = word(i)["start"] + lead
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"),
                        value.alias("value"), i.alias("i"), n.alias("n"), first.alias("first"))

    def candidates(w, i):
        number = F.rtrim(w["value"]).rlike(NUMBER)
        longest = F.when(number, reach(i, 1)).otherwise(1)
        # An array of one element binds what is computed once per word.
        return F.flatten(F.transform(F.array(longest), lambda most: F.flatten(F.transform(
            F.array(F.xxhash64(joint(i, most))), lambda first: F.filter(F.transform(
                F.sequence(F.lit(1), most), lambda n: candidate(i, n, first)),
                lambda c: F.size(_shapes(c["value"])) > 0)))))

    def placed(c):
        j = c["i"] + c["n"] - 1
        return F.flatten(F.transform(F.array(reach(j, -1)), lambda n: F.array(F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value"),
            c["first"].alias("first"), F.xxhash64(joint(j - n + 1, n)).alias("last")))))[0]

    df = df.withColumn("_loose", F.transform(
        F.flatten(F.transform("_words", candidates)), placed))
    return df.select(
        "id", F.xxhash64("text").alias("text_hash"),
        _with_context("base", lambda s: [s["kind"].alias("kind")]).alias("base"),
        _with_context("_loose", lambda s: [
            _shapes(s["value"]).alias("kinds"), s["first"].alias("first"),
            s["last"].alias("last")]).alias("loose"))


def bootstrap(held: DataFrame, min_support: int = MIN_SUPPORT,
              min_confidence: float = MIN_CONFIDENCE, min_score: float = MIN_SCORE,
              max_rounds: int | None = None) -> DataFrame:
    """(value, kind, score) of the unseen identifiers in ``held`` mentions.

    Patterns count places: candidates of one run that begin, or end, together
    are one.  ``max_rounds`` is for tests; without it rounds go on until one
    finds nothing.
    """
    spark = held.sparkSession
    seeds = held.select(F.explode("base").alias("m")).select(
        "m.value", F.array("m.kind").alias("kinds"), "m.left", "m.right", "m.kind",
        F.xxhash64("m.value").alias("first"), F.xxhash64("m.value").alias("last"))
    loose = held.select(F.explode("loose").alias("m")).select(
        "m.value", "m.kinds", "m.left", "m.right", F.lit(None).cast("string").alias("kind"),
        "m.first", "m.last")
    both = seeds.union(loose)
    edges = stored(both.select("value", "kinds", "kind", F.explode(F.array(
        F.struct(F.lit("before").alias("side"), F.col("left").alias("word"), F.col("first").alias("place")),
        F.struct(F.lit("after").alias("side"), F.col("right").alias("word"),
                 F.col("last").alias("place")))).alias("p"))
        .select("p.side", "p.word", "p.place", "value", "kinds", "kind").where("word <> ''").distinct(),
        "pii-edges")
    known = stored(edges.where("kind is not null").select("value", "kind").distinct(), "pii-known")
    found = spark.createDataFrame([], "value string, kind string, score double")
    links = edges.select("side", "word", "place", "value").distinct()
    totals = stored(links.select("side", "word", "place").distinct().groupBy("side", "word").agg(
        F.count(F.lit(1)).alias("total")), "pii-totals")
    for _ in count() if max_rounds is None else range(max_rounds):
        hits = links.join(known, "value").select("side", "word", "kind", "place").distinct().groupBy(
            "side", "word", "kind").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= min_support)
        patterns = stored(
            hits.join(totals, ["side", "word"])
            .withColumn("confidence", F.col("support") / F.col("total"))
            .where(F.col("confidence") >= min_confidence)
            .select("side", "word", F.col("kind").alias("as_kind"), "confidence"), "pii-patterns")
        unseen = edges.where("kind is null").select("side", "word", "value", "kinds").distinct()
        scored = (unseen.join(patterns, ["side", "word"])
                  .where(F.array_contains("kinds", F.col("as_kind")))
                  .groupBy("value", F.col("as_kind").alias("kind"))
                  .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence") + 1e-9)))).alias("score"))
                  .where(F.col("score") >= min_score))
        fresh = stored(scored.join(known, ["value", "kind"], "left_anti"), "pii-found")
        if fresh.isEmpty():
            break
        found = stored(found.unionByName(fresh.select("value", "kind", "score")), "pii-scores")
        known = stored(known.unionByName(fresh.select("value", "kind")), "pii-known")
    return stored(found, "pii-identifiers")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         **bootstrap_options) -> DataFrame:
    """(id, base, spans): arrays of (start, kind order, end, kind, value).

    One row for every input row; offsets are code points, the end exclusive.
    ``spans`` holds the base matches and those the bootstrap added, by start,
    kind order and end.  Null and empty texts have no spans.  Null ids and
    repeated rows keep their rows; other columns are ignored.
    """
    held = stored(mentions(docs, id_col, text_col), "pii-mentions")
    found = bootstrap(held, **bootstrap_options)
    order = F.array(*[F.lit(k) for k in KINDS])

    def entry(kind, s):
        return F.struct(s["start"].alias("start"),
                        F.array_position(order, kind).cast("int").alias("nth"),
                        s["end"].alias("end"), kind.alias("kind"), s["value"].alias("value"))

    added = (held.where(F.size("loose") > 0)
             .select("id", "text_hash", F.explode("loose").alias("m"))
             .select("id", "text_hash", "m", F.col("m.value").alias("value"))
             .join(found.select("value", "kind"), "value")
             .select("id", "text_hash", entry(F.col("kind"), F.col("m")).alias("span")))
    added = added.groupBy("id", "text_hash").agg(F.collect_set("span").alias("added"))

    def inside(s, t):
        return ((s["kind"] == t["kind"]) & (t["start"] <= s["start"]) & (s["end"] <= t["end"])
                & (t["end"] - t["start"] > s["end"] - s["start"]))

    # A candidate inside a longer one that was found too is a part of it.
    added = stored(added.withColumn("added", F.filter(
        "added", lambda s: ~F.exists("added", lambda t: inside(s, t)))), "pii-added")
    base = F.array_sort(F.transform("base", lambda s: entry(s["kind"], s)))
    marks = held.select("id", "text_hash", base.alias("base"))
    joined = marks.alias("h").join(
        added.alias("a"), F.col("h.id").eqNullSafe(F.col("a.id"))
        & (F.col("h.text_hash") == F.col("a.text_hash")), "left")
    spans = F.when(F.col("a.added").isNull(), F.col("h.base")).otherwise(
        F.array_sort(F.concat("h.base", "a.added")))
    return joined.select(F.col("h.id").alias(id_col), F.col("h.base").alias("base"),
                         spans.alias("spans"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def contract_columns(found: DataFrame) -> DataFrame:
    def counted(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [counted(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"),
                        _listed("spans").alias("spans"))
