"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Fixed patterns give the base spans: e-mail addresses, IP addresses, card numbers, phone numbers.
They are the seed entities. The word before and the word after a token are lexical patterns; a pattern's
confidence is the sum of its instances' scores over all occurrences of its word in the corpus, and
an instance's score is 1 for seeds and otherwise the noisy-or of its patterns' confidences. After
`ROUNDS` rounds over this pattern-instance graph, confident patterns discover tokens with a digit or an
at sign that no fixed pattern knows; their spans have the kind `context_` and the seeds' kind.

Positions come from splitting a text at a pattern: starts are sums of the lengths of gaps and
matches before. The patterns have no repeated groups, so that their depth does not grow with the
text; where a repeated group would be needed, characters that cannot stand in a match are replaced
by others first, one for one.

Defined results: a null text is empty and has no span. Matches of a kind do not overlap; one that
fails its kind's condition is dropped and not tried again. Equal starts are ordered by kind as listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed
from quarterwise.llm.shared import cut

KINDS = ("email", "ip", "card", "phone")
FOUND = "context_"
ROUNDS = 3
#: A pattern needs so many different seeds to be scored, and this confidence to discover.
LEAST_SEEDS, CONFIDENT = 3, 0.5

# The base patterns. Possessive loops over single characters only.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]*+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9\x20-]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: A dot that no label follows cannot stand in a domain; `_` can stand wherever a dot can before the at sign.
DOT_OUTSIDE_DOMAIN = r"\.(?![A-Za-z0-9-])"
#: A space or hyphen that is not between two digits cannot stand in a card number.
GAP_OUTSIDE_CARD = r"(?<![0-9])[\x20-]|[\x20-](?![0-9])"
TWELVE_DIGITS = r"[0-9](?:[\x20-]?[0-9]){11}"
BYTE = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
WORD = r"\p{L}_"
_NEAR = 64


def _pieces(kind: str, text: Column, pattern: str, possible: Column, context: bool = False) -> Column:
    """Array of (kind, k, gap, hit, before, after): matches in order, the length of the gap before each, and the text around it."""
    text = F.when(possible, text).otherwise(F.lit(""))
    near = (lambda g: (F.right(g, F.lit(_NEAR)), F.left(g, F.lit(_NEAR)))) if context else (lambda g: (F.lit(""), F.lit("")))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.struct(F.length(g).alias("gap"), near(g)[0].alias("tail"), near(g)[1].alias("head")))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(hits.alias("hit"), gaps.alias("before"), F.slice(gaps, 2, F.lit(2**31 - 1)).alias("after"))
    made = F.transform(
        F.filter(zipped, lambda x: x["hit"].isNotNull()),
        lambda x, k: F.struct(F.lit(kind).alias("kind"), k.alias("k"), x["before"]["gap"].alias("gap"), x["hit"].alias("hit"), x["before"]["tail"].alias("before"), x["after"]["head"].alias("after")),
    )
    return made


def _placed(rows: DataFrame) -> DataFrame:
    """(at, kind, start, end, hit, before, after) of rows (at, pieces)."""
    upto = Window.partitionBy("at", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = rows.where(F.size("pieces") > 0).select("at", F.explode("pieces").alias("p")).select("at", "p.*")
    end = F.sum(F.col("gap") + F.length("hit")).over(upto)
    return parts.withColumn("end", end.cast("bigint")).withColumn("start", F.col("end") - F.length("hit")).drop("gap", "k")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right, from the last digit on."""
    from_last = F.transform(F.split(F.reverse(digits), ""), lambda d, k: F.coalesce(d.try_cast("int"), F.lit(0)) * (1 + k % 2))
    return F.aggregate(from_last, F.lit(0), lambda total, d: total + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def _holds() -> Column:
    """The condition of each kind."""
    hit, kind = F.col("hit"), F.col("kind")
    digits = F.regexp_replace(hit, "[^0-9]", "")
    parts = F.forall(F.split(hit, r"\."), lambda p: p.rlike(BYTE))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", parts)
        .when(kind == "card", F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", F.length(digits).between(9, 15))
        .otherwise(False)
    )


def _last_word(text: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(text, f"([{WORD}]+)[^{WORD}]*$", 1)), F.lit(""))


def _first_word(text: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(text, f"^[^{WORD}]*([{WORD}]+)", 1)), F.lit(""))


def _tokens(placed: DataFrame, base: DataFrame) -> DataFrame:
    """(at, start, end, instance, seed, pattern): tokens in their contexts. seed: the kind of a base span that begins in the token.

    A token that a base span reaches from before is neither a seed nor a candidate.
    """
    marks = base.select("at", "start", "end", "kind", F.lit(None).cast("string").alias("hit"), F.lit("").alias("before"), F.lit("").alias("after"))
    every = placed.where("kind = 'token'").select("at", "start", "end", "kind", "hit", "before", "after").unionByName(marks)
    is_base = F.col("kind") != "token"
    back = Window.partitionBy("at").orderBy("start", F.when(is_base, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy("at").orderBy(F.desc("start"), F.when(is_base, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    span = F.struct("start", "end", "kind")
    seen = every.withColumn("reach", F.max(F.when(is_base, F.col("end"))).over(back)).withColumn("next", F.min(F.when(is_base, span)).over(ahead))
    inside = (F.col("next.start") >= F.col("start")) & (F.col("next.start") < F.col("end"))
    tokens = seen.where("kind = 'token'").withColumn("seed", F.when(inside, F.col("next.kind")))
    tokens = tokens.where(F.col("seed").isNotNull() | F.col("reach").isNull() | (F.col("reach") <= F.col("start")))
    lead = F.length(F.regexp_extract("hit", r"^[^\p{L}0-9+@]*", 0))
    core = F.regexp_replace("hit", r"^[^\p{L}0-9+@]+|[^\p{L}0-9]+$", "")
    contexts = F.array(F.struct(F.lit("before").alias("side"), _last_word(F.col("before")).alias("word")), F.struct(F.lit("after").alias("side"), _first_word(F.col("after")).alias("word")))
    cored = tokens.select("at", (F.col("start") + lead).alias("start"), core.alias("core"), "seed", F.explode(contexts).alias("pattern"))
    return cored.where("core <> '' and pattern.word is not null").select("at", "start", (F.col("start") + F.length("core")).alias("end"), F.lower("core").alias("instance"), "seed", "pattern.side", "pattern.word")


def _confidence(edges: DataFrame, totals: DataFrame) -> DataFrame:
    """(side, word, kind, confidence) after all rounds, of edges (side, word, instance, seed, n)."""
    seeds = edges.where("seed is not null").groupBy("side", "word", F.col("seed").alias("kind")).agg(F.count(F.lit(1)).alias("seeds"), F.sum("n").alias("sure"))
    patterns = cut(seeds.where(F.col("seeds") >= LEAST_SEEDS).join(totals, "word").select("side", "word", "kind", "sure", "total"))
    known = patterns.withColumn("confidence", F.least(F.col("sure") / F.col("total"), F.lit(1.0)))
    unseen = edges.where("seed is null").select("side", "word", "instance", "n")
    for _ in range(ROUNDS - 1):
        doubt = F.sum(F.log1p(-F.least("confidence", F.lit(1 - 1e-9))))
        instances = unseen.join(known.select("side", "word", "kind", "confidence"), ["side", "word"]).groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
        gained = unseen.join(instances, "instance").groupBy("side", "word", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("gained"))
        joined = patterns.join(gained, ["side", "word", "kind"], "left")
        known = cut(joined.withColumn("confidence", F.least((F.col("sure") + F.coalesce("gained", F.lit(0.0))) / F.col("total"), F.lit(1.0))).drop("gained"))
    return known.select("side", "word", "kind", "confidence")


def word_totals(texts: DataFrame) -> DataFrame:
    """(word, total) over all texts (text)."""
    return texts.select(F.explode(F.split(F.lower("text"), f"[^{WORD}]+")).alias("word")).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("total"))


def spans(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Column `row` with the document's columns (`keep`: only these), and spans: array of (start, end, kind), by start and kind."""
    texts = packed(docs, keep, text=F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    whole = F.col("text")
    digit = whole.rlike("[0-9]")
    pieces = F.concat(
        _pieces("email", F.regexp_replace(whole, DOT_OUTSIDE_DOMAIN, "_"), EMAIL, F.contains(whole, F.lit("@"))),
        _pieces("ip", whole, IP, whole.rlike(IP)),
        _pieces("card", F.regexp_replace(whole, GAP_OUTSIDE_CARD, "\u0001"), CARD, whole.rlike(TWELVE_DIGITS)),
        _pieces("phone", whole, PHONE, F.contains(whole, F.lit("+"))),
        _pieces("token", whole, TOKEN, digit | F.contains(whole, F.lit("@")), context=True),
    )
    found = cut(texts.select("row", pieces.alias("pieces"), F.monotonically_increasing_id().alias("at")))
    placed = cut(_placed(found))
    base = placed.where(_holds()).select("at", "start", "end", "kind")
    tokens = cut(_tokens(placed, base))
    edges = tokens.groupBy("side", "word", "instance", "seed").agg(F.count(F.lit(1)).alias("n"))
    sure = _confidence(edges, word_totals(texts)).where(F.col("confidence") >= CONFIDENT)
    new = tokens.where("seed is null").join(sure, ["side", "word"]).select("at", "start", "end", F.concat(F.lit(FOUND), "kind").alias("kind")).distinct()
    order = F.array_position(F.lit([*KINDS, *(FOUND + k for k in KINDS)]), F.col("kind"))
    listed = base.unionByName(new).groupBy("at").agg(F.array_sort(F.collect_list(F.struct("start", order.alias("place"), "end", "kind"))).alias("spans"))
    plain = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint, kind: string>>)")
    return found.select("row", "at").join(listed, "at", "left").select("row", F.coalesce(plain, none).alias("spans"))
