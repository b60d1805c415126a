"""Personal data by weak supervision.

Spans that the fixed rules find stay as they are. Looser patterns give
candidates for more. Labelers (the rule itself, shape,
boundary, gazetteer and context) vote yes, no or not at all on every
candidate. Expectation-maximisation over the counts of vote patterns estimates
how reliable each labeler is and how likely a pattern is a true span; with
these as soft labels a naive Bayes classifier on features of the span is
trained, and it decides on the candidates that no rule covers.

Everything runs as column expressions. Matching is linear in the text: runs
are matched possessively and only from their beginning, or from the end of the
match before, where a new one may begin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import documents, text_of, with_row
from lakeloom.session import materialise

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns of the contract, as matched from left to right without overlap.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further candidates: addresses with spelt-out signs, and numbers without a country code.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\s?[\[({]at[\])}]\s?[a-z0-9-]{1,63}"
             r"(?:\s?(?:[\[({]dot[\])}]|\.)\s?[a-z0-9-]{1,63}){1,8}",
    "phone": r"(?<![0-9A-Za-z+.-])(?<!\+[0-9]{1,3}[\x20.-]{0,1})\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
}
# Cheap tests that a text must pass before a pattern is tried on it.
_TRIGGER = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": r"\+[0-9]"}
_LOOSE_TRIGGER = {"email": r"(?i)[\[({]at[\])}]", "phone": r"[0-9]{3}[\x20.-][0-9]{4}"}
DOMAINS = "com org net edu gov mil int info biz name pro io co ai app dev me tv us uk de fr es it nl be ch at eu se no dk fi pl pt ru jp cn in br au ca mx".split()
YES_WORDS = {
    "email": "mail email e-mail contact write reach address", "ip": "ip host server address login client from",
    "card": "card visa mastercard amex credit debit payment pay account", "phone": "phone tel call mobile cell fax contact dial",
}
NO_WORDS = "version release build isbn order invoice sku serial hash commit token key section chapter figure table"
LABELERS, ROUNDS, CONTEXT = 5, 40, 40
#: Probability from which a candidate outside the rules is taken.
ACCEPT = 0.5


def _matches(texts: DataFrame, kind: str, pattern: str, trigger: str, loose: bool) -> DataFrame:
    """(_row, kind, loose, start, end, value, left, right) of all matches of a pattern.

    The text is cut at the matches; positions are running sums over the
    lengths of the parts, so that a text with very many matches costs no more
    than one pass.
    """
    parts = F.zip_with(
        F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), 0),
        lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
    cut = texts.where(F.col("text").rlike(trigger)).select("_row", parts.alias("parts"))
    cut = cut.where(F.size("parts") > 1).select(
        "_row", F.posexplode(F.transform("parts", lambda p, i: F.struct(
            F.length(p["gap"]).alias("gap"), F.coalesce(F.length(p["value"]), F.lit(0)).alias("size"), p["value"].alias("value"),
            F.lower(F.right(p["gap"], F.lit(CONTEXT))).alias("left"),
            F.left(F.get("parts", i + 1)["gap"], F.lit(1)).alias("right")))).alias("pos", "p"))
    before = Window.partitionBy("_row").orderBy("pos")
    end = F.sum(F.col("p.gap") + F.col("p.size")).over(before)
    return (cut.withColumn("end", end).where("p.value is not null")
            .select("_row", F.lit(kind).alias("kind"), F.lit(loose).alias("loose"),
                    (F.col("end") - F.col("p.size")).alias("start"), "end", "p.value", "p.left", "p.right"))


def _digits() -> Column:
    return F.regexp_replace("value", "[^0-9]", "")


def _valid() -> Column:
    """Does a match of a fixed pattern pass the rule of its kind?"""
    byte = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    count = F.length(_digits())
    return (F.when(F.col("loose"), False)
            .when(F.col("kind") == "email", True)
            .when(F.col("kind") == "ip", F.col("value").rlike(rf"\A{byte}(?:\.{byte}){{3}}\z"))
            .when(F.col("kind") == "card", F.when(count.between(16, 19), F.call_function("luhn_check", _digits())).otherwise(False))
            .otherwise(count.between(8, 15)))


def candidates(docs: DataFrame) -> DataFrame:
    """Every match of every pattern in the rows of ``docs``, and whether a rule makes it a span (``base``).

    A match that fails the rule of its own pattern is dropped, but for cards
    of 13 to 15 digits with a right checksum.
    """
    texts = with_row(docs.select(text_of().alias("text")), "_row")
    found = None
    for loose, patterns, triggers in ((False, BASE, _TRIGGER), (True, LOOSE, _LOOSE_TRIGGER)):
        for kind, pattern in patterns.items():
            more = _matches(texts, kind, pattern, triggers[kind], loose)
            found = more if found is None else found.union(more)
    short_card = (F.col("kind") == "card") & F.length(_digits()).between(13, 15) & F.call_function("luhn_check", _digits())
    return found.withColumn("base", _valid()).where(F.col("base") | F.col("loose") | short_card)


def _vote(yes: Column, no: Column) -> Column:
    """2 for yes, 0 for no, 1 for neither."""
    return F.when(yes, 2).when(no, 0).otherwise(1)


def _votes() -> Column:
    """One vote per labeler: rule, shape, boundary, gazetteer, context."""
    digits, kind, value = _digits(), F.col("kind"), F.col("value")

    def by_kind(**cases: Column) -> Column:
        out = F.lit(1)
        for name, vote in cases.items():
            out = F.when(kind == name, vote).otherwise(out)
        return out

    rule = _vote(F.col("base"), ~F.col("loose"))
    shape = by_kind(
        email=_vote(F.length(value) <= 100, value.rlike(r"\.\.|^[.-]")),
        ip=_vote(value.rlike(r"\A(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}\z"), value.rlike(r"(?:\A|\.)0[0-9]|[0-9]{4}")),
        card=_vote(value.rlike(r"\A[0-9]+\z|\A[0-9]{4}(?:[\x20-][0-9]{4}){3}\z|\A[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}\z"),
                   value.rlike(r"[\x20-][0-9]{1,2}[\x20-]")),
        phone=_vote(value.rlike(r"[0-9]{3}[\x20.)-]+[0-9]{3}[\x20.-][0-9]{4}\z|\A\+[0-9]{8,15}\z"), value.rlike(r"[.]{2}|[(][^)]*\z")))
    word = "[A-Za-z0-9_]"
    boundary = _vote(~F.col("left").rlike(f"{word}\\z") & ~F.coalesce(F.col("right"), F.lit("")).rlike(word),
                     F.col("left").rlike(f"{word}\\z"))
    area = F.substring(F.when(F.length(digits) > 10, F.right(digits, F.lit(10))).otherwise(digits), 1, 1)
    gazetteer = by_kind(
        email=_vote(F.lower(F.regexp_extract("value", r"([A-Za-z0-9-]+)[\])}]?\z", 1)).isin(DOMAINS), value.rlike(r"\.[0-9]+\z")),
        ip=_vote(F.regexp_extract("value", r"\A0*([0-9]{0,3})", 1).cast("int").between(1, 223), value.rlike(r"\A0+\.")),
        card=_vote(digits.rlike(r"\A(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5|2))"), digits.rlike(r"\A[0189]")),
        phone=_vote(area.between("2", "9"), area.isin("0", "1")))
    near = F.col("left")
    yes = F.lit(False)
    for name, words in YES_WORDS.items():
        yes = yes | ((kind == name) & near.rlike(rf"\b(?:{'|'.join(words.split())})\b"))
    context = _vote(yes, near.rlike(rf"\b(?:{'|'.join(NO_WORDS.split())})\b[^a-z]*\z"))
    return F.array(rule, shape, boundary, gazetteer, context)


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, votes, posterior): expectation-maximisation over counted vote patterns (kind, votes, n).

    One row per kind holds all its patterns, of which there are at most 3 to
    the power of the labelers. Odd rounds estimate the posterior of each
    pattern, even rounds the prior and each labeler's chances of each vote.
    """
    size = LABELERS
    table = patterns.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("p"))
    # Chances of the votes no, none, yes; first for false, then for true spans; labeler by labeler.
    start = [0.5, 0.35, 0.15] * size + [0.15, 0.35, 0.5] * size
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x["n"])

    def posterior(state: Column, x: Column) -> Column:
        odds = F.log(state["prior"] / (1 - state["prior"]))
        for k in range(size):
            vote = F.element_at(x["votes"], k + 1)
            odds = odds + F.log(F.element_at(state["theta"], 3 * (size + k) + vote + 1)) \
                - F.log(F.element_at(state["theta"], 3 * k + vote + 1))
        return 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), odds))))

    def weight(state: Column, true: bool, k: int | None = None, vote: int | None = None) -> Column:
        def add(a: Column, x: Column) -> Column:
            part = x["n"] * (x["q"] if true else 1 - x["q"])
            return a + (part if k is None else F.when(F.element_at(x["votes"], k + 1) == vote, part).otherwise(0.0))
        rows = F.zip_with("p", state["q"], lambda x, q: F.struct(x["votes"].alias("votes"), x["n"].alias("n"), q.alias("q")))
        return F.aggregate(rows, F.lit(0.0), add)

    def step(state: Column, i: Column) -> Column:
        theta = F.array(*[(weight(state, true, k, v) + 1.0) / (weight(state, true) + 3.0)
                          for true in (False, True) for k in range(size) for v in range(3)])
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, state["prior"]).otherwise((weight(state, True) + 1.0) / (total + 2.0)).alias("prior"),
            F.when(odd, state["theta"]).otherwise(theta).alias("theta"),
            F.when(odd, F.transform("p", lambda x: posterior(state, x))).otherwise(state["q"]).alias("q"))

    first = F.struct(F.lit(0.5).alias("prior"), F.array(*map(F.lit, start)).alias("theta"),
                     F.transform("p", lambda x: F.lit(0.5)).alias("q"))
    state = F.aggregate(F.sequence(F.lit(1), F.lit(2 * rounds - 1)), first, step)
    out = table.select("kind", F.explode(F.arrays_zip("p", state["q"].alias("q"))).alias("z"))
    return out.select("kind", F.col("z.p.votes").alias("votes"), F.col("z.q").alias("posterior"))


def _features() -> Column:
    """What the span classifier sees: sizes, characters and neighbours, as text values."""
    digits = F.length(_digits())
    return F.array(
        F.concat(F.lit("digits="), F.least(digits, F.lit(20)).cast("string")),
        F.concat(F.lit("size="), F.least(F.floor(F.length("value") / 4), F.lit(12)).cast("string")),
        F.concat(F.lit("shape="), F.substring(F.regexp_replace(F.regexp_replace("value", "[0-9]+", "9"), r"\p{L}+", "a"), 1, 12)),
        F.concat(F.lit("left="), F.regexp_replace(F.right("left", F.lit(1)), r"[\p{L}0-9]", "w")),
        F.concat(F.lit("right="), F.regexp_replace(F.coalesce("right", F.lit("")), r"[\p{L}0-9]", "w")))


def classified(found: DataFrame) -> DataFrame:
    """``found`` with ``posterior`` (of the votes) and ``score`` (of the trained span classifier)."""
    voted = materialise(found.withColumn("votes", _votes()).withColumn("features", _features()), "candidates")
    counts = voted.groupBy("kind", "votes").agg(F.count("*").cast("double").alias("n"))
    # At most one row for each kind and pattern of votes.
    likely = F.broadcast(materialise(reliabilities(counts), "posteriors"))
    soft = voted.join(likely, ["kind", "votes"])
    q = F.col("posterior")
    totals = soft.groupBy("kind").agg(F.sum(q).alias("true"), F.sum(1 - q).alias("false"))
    # Sizes, counts, and shapes of twelve characters over a small alphabet; joined without a hint, as shapes may vary.
    weights = (soft.select("kind", F.explode("features").alias("feature"), "posterior").groupBy("kind", "feature")
               .agg(F.sum(q).alias("t"), F.sum(1 - q).alias("f")).join(F.broadcast(totals), "kind")
               .select("kind", "feature", (F.log((F.col("t") + 0.5) / (F.col("true") + 1.0))
                                           - F.log((F.col("f") + 0.5) / (F.col("false") + 1.0))).alias("weight")))
    # Only candidates outside the rules wait for a decision.
    open_ones = soft.where(~F.col("base"))
    scored = (open_ones.select("_row", "kind", "start", "end", F.explode("features").alias("feature"))
              .join(weights, ["kind", "feature"]).groupBy("_row", "kind", "start", "end").agg(F.sum("weight").alias("w"))
              .join(F.broadcast(totals), "kind")
              .select("_row", "kind", "start", "end",
                      (1 / (1 + F.exp(-(F.col("w") + F.log((F.col("true") + 1) / (F.col("false") + 1)))))).alias("score")))
    return (soft.drop("features").join(scored, ["_row", "kind", "start", "end"], "left")
            .withColumn("score", F.coalesce("score", F.lit(1.0))))


def spans(docs: DataFrame) -> DataFrame:
    """(_row, kind, start, end, value, base, posterior, score): the spans of the rows of ``docs`` (a stored table).

    Positions are code points, the end exclusive. A span outside the rules is
    taken if the classifier accepts it, the votes agree, and it touches no
    span of the rules. Null texts count as empty; other columns are ignored;
    repeated rows have their spans each.
    """
    taken = classified(candidates(docs)).where(
        F.col("base") | ((F.col("score") >= ACCEPT) & (F.col("posterior") >= ACCEPT)))
    by_start = Window.partitionBy("_row").orderBy("start", "end")
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    coming = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(coming, F.col("end")) >= F.col("end"))
    return taken.withColumn("_free", free).where(F.col("base") | F.col("_free")).select(
        "_row", "kind", "start", "end", "value", "base", "posterior", "score")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = spans(docs).withColumn("order", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")))
    item = F.struct("order", "start", "end", "base", F.concat_ws(":", "kind", "start", "end").alias("said"))
    per_row = found.groupBy("_row").agg(
        F.sort_array(F.collect_list(item)).alias("all"),
        *[F.count(F.when(F.col("base") & (F.col("kind") == kind), 1)).alias(f"n_{kind}") for kind in KINDS])
    said = lambda a: F.array_join(F.transform(a, lambda x: x["said"]), ",")
    per_row = per_row.withColumn("base_said", said(F.filter("all", lambda x: x["base"]))).withColumn("said", said("all"))
    rows = with_row(docs.select("doc_id"), "_row").join(per_row, "_row", "left")
    return rows.select("doc_id", *[F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS],
                       F.sha2(F.coalesce("base_said", F.lit("")), 256).alias("base_sha256"),
                       F.coalesce("said", F.lit("")).alias("spans"))
