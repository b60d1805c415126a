"""Benchmark decontamination by template windows.

Numbers, units and names of a text become typed placeholders; a second reading
keeps names as lower-cased words. Windows of the remaining template are hashed
and joined with those of the benchmark, so that a question is found again when
only its parameters were changed. Hashes are first looked up in a bit table of
the benchmark's hashes where they are made: only texts that meet one (in either
reading) get slots and take part in the join. The windows of one item
must lie on one diagonal (the same distance in text and item) or on a few
neighbouring ones and cover enough of the item, and its slots must be filled
consistently: one value of the item stands for one value in the document
throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.functions.common import let
from lakeloom.llm.common import DOCUMENT_COLUMNS, by_row, documents, text_of, with_row
from lakeloom.session import materialise

#: Tokens of a window, the share of an item's windows that must be met, and the benchmark windows that are broadcast.
WINDOW, COVERAGE, BROADCAST_WINDOWS = 5, 0.8, 500_000
#: One altered, dropped or inserted word is allowed for so many windows of an item; each costs up to a window's tokens.
EDIT_WINDOWS, EDITED_COVERAGE = 16, 0.5
#: Neighbouring diagonals taken together: so many tokens may be inserted or dropped in one place or in all.
BAND = 8
#: Bits of the table that says which hashes the benchmark may have: 1 MB, whatever the size of the benchmark.
TABLE_BITS = 1 << 23
# Placeholders: private-use characters, which are taken out of the texts first; a number is a single 0.
NAME, UNIT, NUMBER = "\uE010", "\uE011", "0"
# Marks of names while a text is cut: where a sentence may begin, and the end of a name.
FIRST, END = "\uE012", "\uE013"
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml cl l s ms min h hr hrs hour hours day days week weeks year years "
         "meter meters metre metres kilometer kilometers kilometre kilometres mile miles gram grams kilogram kilograms "
         "liter liters litre litres second seconds minute minutes month months percent dollar dollars euro euros cent cents "
         "degree degrees mph kmh kph hz khz mhz ghz w kw mw v kv a ma j kj cal kcal pa kpa").split()
# Possessive throughout: Java's matcher calls itself once per repetition of any other group, and a text may be all names or digits.
_UNIT = f"(?i:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?!\\p{{L}})"
_NUMBER = rf"[0-9]++(?:[.,][0-9]++)*+(?:\x20?{_UNIT})?+"
_NAME = r"\p{Lu}\p{Ll}\p{L}*+(?:\s++\p{Lu}\p{Ll}\p{L}*+)*+"
#: A token of clean text, and one of marked text: a row of capitalised words, a number with its unit, a word.
_TOKEN = rf"{_NAME}|{_NUMBER}|\p{{L}}++"
_MARKED_TOKEN = rf"[{NAME}{FIRST}][^{END}]*{END}|{_NUMBER}|\p{{L}}++"


def _clean(text: Column) -> Column:
    return F.translate(text, NAME + UNIT + FIRST + END, "    ")


def _marked(text: Column) -> Column:
    """Clean text in which names stand between NAME and END, or FIRST and END where a sentence may begin.

    A name is a row of capitalised words, no matter what white space or quote is before them; words all in capitals are none.
    """
    unit = rf"(?<=[0-9]|[0-9]\x20){_UNIT}"
    named = F.regexp_replace(_clean(text), rf"(?<!\p{{L}})(?!{unit}){_NAME}", f"{NAME}$0{END}")
    return F.regexp_replace(named, rf"(?<![\p{{L}}\p{{N}},;:){END}][\s\"'“”‘’«»(]{{1,4}}){NAME}", FIRST)


def tokens(text: Column) -> Column:
    """Tokens of a text as they stand in it: names (rows of capitalised words), numbers with their units, and words."""
    return F.regexp_extract_all(_clean(text), F.lit(_TOKEN), 0)


def marked_tokens(text: Column) -> Column:
    """The same tokens, names between their marks."""
    return F.regexp_extract_all(_marked(text), F.lit(_MARKED_TOKEN), 0)


def _is_number(token: Column) -> Column:
    return (token >= "0") & (token < ":")


def _has_unit(token: Column) -> Column:
    return F.substring(token, -1, 1) > "9"


def reading(found: Column, plain: bool) -> Column:
    """Template of the ``tokens`` of a text: lower-cased words and placeholders; ``plain``: names as their words."""
    def parts(token: Column) -> Column:
        low = F.lower(token)
        name = F.split(low, r"\s+") if plain else F.array(F.lit(NAME))
        number = F.when(_has_unit(token), F.array(F.lit(NUMBER), F.lit(UNIT))).otherwise(F.array(F.lit(NUMBER)))
        return (F.when(_is_number(token), number).when((token == low) & (token < "\x80"), F.array(token))
                .when(token.rlike(r"^\p{Lu}\p{Ll}"), name).otherwise(F.array(low)))

    return F.flatten(F.transform(found, parts))


def window_hashes(template: Column, size: int = WINDOW) -> Column:
    """Hash of every window of ``size`` tokens of a template, in order; none if it has fewer."""
    starts = F.when(F.size(template) >= size, F.sequence(F.lit(0), F.size(template) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(template, i + k) for k in range(size)]))


def bit_table(hashes: DataFrame, bits: int = TABLE_BITS) -> Column:
    """A table of ``bits`` bits, 64 a word, as a scalar: set where ``hashes`` (h) has a hash that ends in the bit's number.

    Its size is fixed, so it may go to every task; a larger benchmark only lets more texts through to the exact join.
    """
    spark = hashes.sparkSession
    slot = F.col("h").bitwiseAND(F.lit(bits - 1))
    words = (hashes.groupBy(F.shiftright(slot, 6).alias("id"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))).alias("word")))
    filled = spark.range(bits >> 6).join(words, "id", "left").select(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word")).alias("w"))
    return materialise(filled.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["word"]).alias("words")), "bits").scalar()


def suspects(rows: DataFrame, text: str, known: DataFrame, bounded: bool, size: int = WINDOW, bits: int = TABLE_BITS) -> DataFrame:
    """``_row`` of the ``rows`` whose text has, in either reading, a window that is among the hashes ``known`` (h); stored.

    The bit table leaves about one in a thousand of the other windows to the exact semi-join.
    """
    hashes = let(tokens(text_of(text)), lambda found: F.concat(*[
        let(reading(found, plain), lambda t: window_hashes(t, size)) for plain in (True, False)]))
    slot = F.col("h").bitwiseAND(F.lit(bits - 1))
    word = F.get(bit_table(known, bits), F.shiftright(slot, 6).cast("int"))
    maybe = F.call_function("shiftright", word, slot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    # Windows are looked up as they are made. Outer: else the hashes are made again to drop empty lists first.
    left = rows.select("_row", F.explode_outer(hashes).alias("h")).where(maybe)
    return materialise(left.join(F.broadcast(known) if bounded else known, "h", "left_semi").select("_row").distinct(), "suspects")


def windows(table: DataFrame, key: str, text: str, size: int = WINDOW) -> DataFrame:
    """(key, plain, pos, h, slots): the template windows of each text; slots are the values behind placeholders, null if none.

    Each text has them twice: with names as placeholders, and ``plain``, with
    names as lower-cased words. Templates and values come from one list of
    tokens. Texts with fewer tokens than a window, null and empty ones have none.
    """
    def entry(t: Column, v: Column) -> Column:
        return F.struct(t.alias("t"), v.alias("v"))

    none = F.lit(None).cast("string")

    def parts(token: Column) -> Column:
        """One struct (t, v) per token of the template; v is null for a word."""
        low = F.lower(F.translate(token, NAME + FIRST + END, ""))
        mark = F.when(token.startswith(FIRST), FIRST).otherwise("")
        number, unit = F.regexp_extract(token, r"^[0-9.,]*[0-9]", 0), F.lower(F.regexp_extract(token, r"\p{L}++$", 0))
        name = F.when(F.col("plain"), F.transform(F.split(low, r"\s+"), lambda w: entry(w, none))).otherwise(
            F.array(entry(F.lit(NAME), F.concat(mark, low))))
        return (F.when(_is_number(token) & _has_unit(token), F.array(entry(F.lit(NUMBER), number), entry(F.lit(UNIT), unit)))
                .when(_is_number(token), F.array(entry(F.lit(NUMBER), number)))
                .when(token.startswith(NAME) | token.startswith(FIRST), name).otherwise(F.array(entry(low, none))))

    cut = (table.select(key, F.explode(F.array(F.lit(True), F.lit(False))).alias("plain"), marked_tokens(text_of(text)).alias("m"))
           .select(key, "plain", F.flatten(F.transform("m", parts)).alias("e"))
           .select(key, "plain", "e", F.transform("e", lambda e: e["t"]).alias("t")))
    def window(h: Column, i: Column) -> Column:
        slots = F.filter(F.transform(F.slice("e", i + 1, size), lambda e, k: F.struct(k.alias("at"), e["v"].alias("value"))),
                         lambda s: s["value"].isNotNull())
        return F.struct(h.alias("h"), slots.alias("slots"))

    # Whole windows are made inside the row: the list of tokens must not be copied to each of them.
    made = F.transform(window_hashes(F.col("t"), size), window)
    return (cut.select(key, "plain", F.posexplode_outer(made).alias("pos", "w")).where("pos is not null")
            .select(key, "plain", "pos", F.col("w.h").alias("h"), F.when(F.size("w.slots") > 0, F.col("w.slots")).alias("slots")))


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, coverage: float = COVERAGE,
          broadcast_windows: int | None = None, band: int = BAND, edit_windows: int = EDIT_WINDOWS,
          edited_coverage: float = EDITED_COVERAGE, bits: int = TABLE_BITS) -> DataFrame:
    """(_row, item_id, at, n_windows, item_windows, n_slots, verbatim, plain): items found in rows of ``docs`` (a stored table).

    An item is found where ``coverage`` of its windows lie on one diagonal, or
    where, over diagonals at most ``band`` / 2 apart, it misses no more windows
    than one altered, dropped or inserted word for every ``edit_windows`` (or
    part of them) takes away, and still has ``edited_coverage`` of them.
    A place may be found in both readings, with names as words (``plain``) and
    as placeholders. ``at`` is the token of the text, so read, at which the
    item would begin; neighbouring name words are one token if not plain. ``verbatim``
    tells whether all windows are there and all slots hold the item's own values. Null texts count as
    empty; texts and items with fewer tokens than a window have none and are
    never found. Repeated rows and repeated items are reported each. Other
    columns are ignored.
    """
    items = materialise(windows(benchmark.select("item_id", "text").withColumn("_item", F.monotonically_increasing_id())
                                .select(F.struct("_item", "item_id").alias("item"), "text"), "item", "text", size)
                        .select("item", "plain", F.col("pos").alias("item_pos"), "h", F.col("slots").alias("item_slots")), "items")
    sizes = items.groupBy("item", "plain").agg(F.count("*").alias("item_windows"))
    bounded = items.count() <= (BROADCAST_WINDOWS if broadcast_windows is None else broadcast_windows)
    rows = with_row(docs.select("text"), "_row")
    near = windows(by_row(rows, suspects(rows, "text", items.select("h").distinct(), bounded, size, bits), "left_semi"),
                   "_row", "text", size)
    met = near.join(F.broadcast(items) if bounded else items, ["h", "plain"])
    # Slots of one window side by side: the same templates have them at the same places.
    pairs = F.when(F.col("slots").isNotNull(), F.zip_with(
        "item_slots", "slots", lambda a, b: F.struct((a["at"] + F.col("item_pos")).alias("at"), a["value"].alias("item"), b["value"].alias("doc"))))
    shift = F.col("pos") - F.col("item_pos")
    # Every run of half a band of neighbouring diagonals lies in one of two rows of bands; each diagonal is a group of its own too.
    places = F.explode(F.array(F.struct(F.lit(0).alias("kind"), shift.cast("long").alias("place")),
                               F.struct(F.lit(1).alias("kind"), F.floor(shift / band).alias("place")),
                               F.struct(F.lit(2).alias("kind"), F.floor((shift + band // 2) / band).alias("place"))))
    lines = (met.select("_row", "item", "plain", shift.alias("shift"), "item_pos", pairs.alias("pairs"), places.alias("g"))
             .groupBy("_row", "item", "plain", "g")
             .agg(F.min("shift").alias("at"), F.count_distinct("item_pos").alias("n_windows"),
                  F.flatten(F.collect_set("pairs")).alias("pairs")))
    lines = lines.join(F.broadcast(sizes) if bounded else sizes, ["item", "plain"])
    # A word that may be no name, as a sentence begins with it, need not be filled consistently.
    sure = F.filter("pairs", lambda p: ~(p["item"].startswith(FIRST) | p["doc"].startswith(FIRST)))
    values = F.array_distinct(F.transform(sure, lambda p: p["item"]))
    both = F.array_distinct(F.transform(sure, lambda p: F.struct(p["item"], p["doc"])))
    same = lambda p: F.translate(p["item"], FIRST, "") == F.translate(p["doc"], FIRST, "")
    total = F.col("item_windows")
    edited = F.greatest(total - size * F.ceil(total / edit_windows), F.ceil(F.lit(edited_coverage) * total), F.lit(2))
    exact = F.col("g.kind") == 0
    views = (lines.where(F.col("n_windows") >= F.when(exact, F.ceil(F.lit(coverage) * total)).otherwise(edited))
             .select("_row", "item", "plain", "at", "n_windows", "item_windows", exact.alias("exact"),
                     (F.size(values) == F.size(both)).alias("consistent"),
                     F.size(F.array_distinct(F.transform("pairs", lambda p: p["at"]))).cast("long").alias("n_slots"),
                     (F.forall("pairs", same) & (F.col("n_windows") == total) & exact).alias("verbatim")))
    # Groups that begin within a band of each other are views of one place.
    before = Window.partitionBy("_row", "item", "plain").orderBy("at", "exact", "n_windows")
    apart = F.col("at") - F.lag("at").over(before) >= F.least(F.lit(band), total + F.lit(size - 1))
    place = Window.partitionBy("_row", "item", "plain", "place")
    numbered = (views.withColumn("place", F.sum(F.when(apart, 1).otherwise(0)).over(before))
                .withColumn("most", F.max("n_windows").over(place)))
    # A part of a place is no evidence where the whole of it is filled inconsistently.
    return (numbered.where(F.col("consistent") & (F.col("exact") | (F.col("n_windows") == F.col("most"))))
            .groupBy("_row", "item", "plain", "place")
            .agg(F.max_by(F.struct("at", "n_windows", "item_windows", "n_slots", "verbatim"),
                          F.struct("verbatim", "n_windows", "exact", -F.col("at"))).alias("b"))
            .select("_row", F.col("item.item_id").alias("item_id"), "b.*", "plain"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (a stored table) in which no item is found, with all their columns."""
    found = materialise(leaks(docs, benchmark, **options).select("_row").distinct(), "leaks")
    return by_row(with_row(docs, "_row"), found, "left_anti").drop("_row")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = materialise(leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "leaks")
    # One row per document and item: an item that occurs in a document again is reported once, with its best place.
    # Both readings of a place are one, so places are counted in the reading that has more of them.
    best = found.groupBy("_row", "item_id").agg(
        F.max_by(F.struct("at", "n_windows", "item_windows", "n_slots", "verbatim"),
                 F.struct("verbatim", "plain", "n_windows", -F.col("at"))).alias("b"),
        F.greatest(F.count_if("plain"), F.count_if(~F.col("plain"))).alias("n_places"))
    best = materialise(best, "leaks")
    return by_row(with_row(docs.select("doc_id"), "_row"), best, "inner").select("doc_id", "item_id", "n_places", "b.*")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*DOCUMENT_COLUMNS)
