"""Benchmark items found in documents, also with other numbers, names and units.

Texts are brought to a template: numbers, names and units become typed placeholders, other words
lower-case.  A name is any run of capitalised words, also at the start of a sentence, so that a name is
one wherever it stands.  Windows of template tokens are hashed and joined; a window that is mostly
placeholders is hashed with its values instead, as its template says too little.  Where enough of an item
is covered, the values behind its placeholders are compared: each value of the item must stand for one
value of the document and the other way round, as in a question whose parameters were exchanged.

Items that differ only in their parameters are looked for as one.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.operators.reshape import union_all
from starflow.session import stage

WINDOW = 8
#: A window with fewer tokens that are no placeholders is hashed with its values.
LEAST_LITERALS = 4
#: Windows of benchmark items that are sent to all tasks; beyond it the join shuffles.
MOST_BROADCAST = 1_000_000

# Loops are possessive and look one character round, so no text makes a match recurse or walk back.
_NEXT_NAME = r"(?<![\p{L}\p{N}])(\p{Lu}\p{Ll}++) (?=\p{Lu}\p{Ll})"
_NAME = r"(?<![\p{L}\p{N}=])\p{Lu}\p{Ll}++(?:=\p{Lu}\p{Ll}++)*+"
_PARTED = r"\p{N}[.,]\p{N}"
_POINT, _COMMA = r"(?<=\p{N})\.(?=\p{N})", r"(?<=\p{N}),(?=\p{N})"
_NUMBER = r"\p{N}++(?:==?+\p{N}++)*+"
UNITS = ("km|cm|mm|kg|mg|ml|lb|lbs|oz|ft|mph|kmh|m|g|l|s|h|meters?|metres?|miles?|feet|foot|inch|inches|yards?|"
         "grams?|kilograms?|pounds?|tons?|liters?|litres?|gallons?|seconds?|minutes?|hours?|days?|weeks?|months?|"
         "years?|dollars?|cents?|euros?|percent|degrees?|watts?|volts?")
_UNIT = rf"(?<=\p{{N}}›) ?({UNITS})(?![\p{{L}}\p{{N}}])"
_VALUE = "=[^›]*+›"
_BETWEEN = r"[^\p{L}\p{N}‹›=]++"


def valued(text: Column) -> Column:
    """Text with placeholders that hold their values, such as ``‹num=12›``.

    Within a value a space or a point is ``=`` and a comma ``==``, at which ``tokens`` does not split.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.when(text.contains("=") | text.contains("‹") | text.contains("›"),
                   F.translate(text, "‹›=", "   ")).otherwise(text)
    named = F.regexp_replace(F.regexp_replace(plain, _NEXT_NAME, "$1="), _NAME, "‹name=$0›")
    whole = F.when(plain.rlike(_PARTED), F.regexp_replace(F.regexp_replace(named, _POINT, "="), _COMMA, "==")).otherwise(named)
    numbered = F.regexp_replace(whole, _NUMBER, "‹num=$0›")
    return F.lower(F.regexp_replace(numbered, _UNIT, " ‹unit=$1›"))


def tokens(template: Column) -> Column:
    return F.array_remove(F.split(template, _BETWEEN), "")


def canonical(with_values: Column) -> Column:
    """The tokens of a template without its values."""
    return F.transform(with_values, lambda t: F.when(t.contains("="), F.regexp_replace(t, _VALUE, "›")).otherwise(t))


def _marks(words: Column) -> Column:
    """Places (from 0) of the placeholders."""
    return F.filter(F.transform(words, lambda t, i: F.when(t.contains("‹"), i)), lambda i: i.isNotNull())


def _poor_places(marks: Column, count: Column, size: int) -> Column:
    """Where windows begin that hold fewer than ``LEAST_LITERALS`` other tokens; all in very short ones.

    Such a window holds ``least`` placeholders, so one that begins no later than the first of
    them and ends no earlier than the last.
    """
    none = F.array().cast("array<int>")
    places = F.when(count >= size, F.sequence(F.lit(0), count - size)).otherwise(none)
    least = size - LEAST_LITERALS + 1
    if least < 2:
        return places
    spans = F.zip_with(marks, F.slice(marks, F.lit(least), F.greatest(F.size(marks), F.lit(1))), lambda first, last: F.when(
        last - first < size, F.sequence(F.greatest(last - (size - 1), F.lit(0)), first)))
    begins = F.array_distinct(F.flatten(F.array_compact(spans)))
    return F.filter(begins, lambda i: i <= count - size)


def windows(own: str, words: str, size: int, with_poor: bool = True) -> Column:
    """Hash and place (from 0) of each window of ``size`` tokens, and whether it is hashed with its values.

    A poor window is in it twice, by its template too; no item has the latter.  Poor ones need not be made
    where no item has any.
    """
    count, cut = F.size(words), F.array().cast("array<int>")
    places = F.when(count >= size, F.sequence(F.lit(0), count - size)).otherwise(cut)
    if size <= LEAST_LITERALS:
        places = cut
    plain = F.transform(places, lambda i: F.struct(
        F.xxhash64(F.slice(words, i + 1, size)).alias("h"), i.alias("place"), F.lit(False).alias("poor")))
    if not with_poor:
        return plain
    poor = F.transform(_poor_places(F.col("marks"), count, size), lambda i: F.struct(
        F.xxhash64(F.slice(own, i + 1, size), F.lit(1)).alias("h"), i.alias("place"), F.lit(True).alias("poor")))
    return F.concat(plain, poor)


def _covered(places: Column, size: Column) -> Column:
    """Tokens covered by windows at these sorted places."""
    n = F.size(places)
    steps = F.zip_with(F.slice(places, 2, n), F.slice(places, 1, F.greatest(n - 1, F.lit(0))),
                       lambda b, a: F.least(b - a, size))
    return F.when(n == 0, 0).otherwise(size + F.aggregate(steps, F.lit(0), lambda x, y: x + y))


def _pattern(own: Column, words: Column) -> Column:
    """For each placeholder the place of the one before it that has the same value, or -1."""
    marked = F.filter(F.zip_with(own, F.transform(words, lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda o, w: F.struct(
        o.alias("own"), w["i"].alias("i"), w["t"].alias("t"))), lambda x: x["t"].contains("‹"))
    by_value = F.array_sort(marked)
    before = F.concat(F.slice(F.array(F.lit(None).cast("struct<own:string,i:int,t:string>")), 1, F.least(F.size(by_value), F.lit(1))),
                      F.slice(by_value, F.lit(1), F.greatest(F.size(by_value) - 1, F.lit(0))))
    links = F.zip_with(by_value, before, lambda x, y: F.struct(
        x["i"].alias("i"), F.when(x["own"] == y["own"], y["i"]).otherwise(-1).alias("same")))
    return F.transform(F.array_sort(links), lambda x: x["same"])


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[int], list[DataFrame]]:
    """Items, one row for all that differ only in their parameters, and the windows to look for."""
    rows = stage(benchmark.where(F.col(id_col).isNotNull())
                 .select(F.col(id_col).alias("item_id"), tokens(valued(F.col(text_col))).alias("own"))
                 .withColumn("words", canonical(F.col("own")))
                 .withColumns({"n": F.size("words"), "marks": _marks(F.col("words"))})
                 .where(F.col("n") > 0)
                 .withColumn("class", F.xxhash64("words", _pattern(F.col("own"), F.col("words")))), "leak-item-rows")
    items = stage(rows.groupBy("class", "n").agg(F.min(F.struct("item_id", "own", "words")).alias("least"))
                  .select("class", "n", F.least("n", F.lit(WINDOW)).alias("size"), "least.item_id", "least.own", "least.words"),
                  "leak-items")
    # One value for each size of a window: eight at most.
    sizes = [r["size"] for r in items.select("size").distinct().collect()]
    grams = []
    for size in sizes:
        mine = rows.where(F.least("n", F.lit(WINDOW)) == size)
        every = mine.select("class", F.xxhash64("own").alias("member"), "words", F.explode(windows("own", "words", size)).alias("w"))
        filled = F.size(F.filter(F.slice("words", F.col("w.place") + 1, F.lit(size)), lambda t: t.contains("‹")))
        found = every.select("class", "member", "w.h", "w.place", "w.poor", filled.alias("filled")).where(
            F.col("poor") | (F.col("filled") <= size - LEAST_LITERALS))
        # Windows without values are the same for all members.
        grams.append(found.select(
            "class", F.when(F.col("poor"), F.col("member")).otherwise(0).alias("member"), "h", "place", "poor",
            (~F.col("poor") & (F.col("filled") == 0)).alias("literal")).distinct()
            .groupBy("class", "member", "h", "poor", "literal").agg(F.sort_array(F.collect_list("place")).alias("places")))
    return items, sizes, grams


def leaking_rows(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.4, id_col: str = "doc_id",
                 text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``find_leaks`` for each row of the documents: ``doc_id`` and ``row``, a hash of its text, besides."""
    items, sizes, grams = _items(benchmark, item_id_col, item_text_col)
    row, pair = ["doc_id", "row"], ["doc_id", "row", "class"]
    named = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    own = named.select(*row, tokens(valued(F.col("text"))).alias("own"))
    words = own.withColumn("words", canonical(F.col("own")))
    if not sizes:
        sizes, grams = [WINDOW], [items.select("class", F.lit(0).cast("long").alias("member"), F.lit(0).cast("long").alias("h"),
                                               F.lit(False).alias("poor"), F.lit(False).alias("literal"),
                                               F.array().cast("array<int>").alias("places"))]
    looked_for = stage(union_all(grams), "leak-windows")
    counts = looked_for.agg(F.count("*").alias("all"), F.count_if("poor").alias("poor")).first()
    if counts["all"] <= MOST_BROADCAST:
        looked_for = F.broadcast(looked_for)
    if counts["poor"]:
        words = words.withColumn("marks", _marks(F.col("words")))
    every = F.concat(*(windows("own", "words", k, counts["poor"] > 0) for k in sizes))
    found = words.select(*row, F.explode(every).alias("w"))
    hits = stage(found.select(*row, "w.h", "w.poor", F.col("w.place").alias("doc_place")).join(looked_for, ["h", "poor"])
                 .drop("h"), "leak-hits")

    # What could be covered at most, before any value is looked at.
    facts = items.select("class", "item_id", "n", "size")
    near = (hits.groupBy(*pair).agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"))
            .join(facts, "class")
            .where(_covered(F.sort_array("places"), F.col("size")) >= coverage * F.col("n")))
    near = stage(near.select(*pair, "item_id", "n", "size"), "leak-near")
    hits = hits.join(near.select(*pair), pair, "left_semi")

    # Where a window with placeholders lies in the document against its place in the item is a shift.
    shifted = (hits.where(~F.col("literal") & ~F.col("poor")).join(near.select(*pair, "size"), pair)
               .select(*pair, "size", "doc_place", F.explode("places").alias("place"))
               .withColumn("shift", F.col("doc_place") - F.col("place")))
    shifted = stage(shifted, "leak-shifted")
    slots = (items.select("class", F.posexplode("own").alias("item_at", "item_value"))
             .where(F.col("item_value").contains("‹")))
    at = (shifted.select(*pair, "shift", F.explode(F.sequence(F.col("place"), F.col("place") + F.col("size") - 1)).alias("item_at"))
          .distinct().join(slots, ["class", "item_at"]))
    values = _own(named, shifted.select(*row).distinct(), row)
    compared = at.join(values, row).select(
        *pair, "shift", "item_value", F.get("own", F.col("item_at") + F.col("shift")).alias("doc_value"))
    one_way = compared.groupBy(*pair, "shift", "item_value", "doc_value").agg(F.count("*").alias("slots"))
    # One to one at this shift: as many pairs of values as values on either side.
    judged = stage(one_way.groupBy(*pair, "shift").agg(
        F.sum("slots").alias("slots"), (
            (F.count("*") == F.count_distinct("item_value")) & (F.count("*") == F.count_distinct("doc_value"))).alias("sound")),
        "leak-shifts")

    # What counts: windows without placeholders, those at sound shifts, and those found with their values.
    sound = (shifted.join(judged.where("sound"), [*pair, "shift"], "left_semi")
             .groupBy(*pair).agg(F.collect_set("place").alias("sound_places")))
    literal = (hits.where("literal").groupBy(*pair)
               .agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("literal_places")))
    members = (hits.where("poor").groupBy(*pair, "member")
               .agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("member_places")))
    shifts = judged.groupBy(*pair).agg(F.sum("slots").alias("slots"), F.max("sound").alias("any_sound"))
    none = F.array().cast("array<int>")
    whole = (near.join(sound, pair, "left").join(literal, pair, "left").join(members, pair, "left").join(shifts, pair, "left")
             .withColumns({c: F.coalesce(c, none) for c in ("sound_places", "literal_places", "member_places")}))
    places = F.array_sort(F.array_union(F.array_union("sound_places", "literal_places"), "member_places"))
    return (whole.select(*row, "item_id", F.col("n").alias("tokens"), _covered(places, F.col("size")).alias("covered"),
                         _covered(F.array_sort("literal_places"), F.col("size")).alias("literal"),
                         F.coalesce("slots", F.lit(0)).cast("long").alias("slots"),
                         F.coalesce("any_sound", F.lit(True)).alias("consistent"))
            .where(F.col("covered") >= coverage * F.col("tokens")))


def _own(named: DataFrame, wanted: DataFrame, row: list[str]) -> DataFrame:
    """Tokens with values of the rows that are wanted; the same text under one id once."""
    chosen = named.join(wanted, row, "left_semi").dropDuplicates(row)
    return chosen.select(*row, tokens(valued(F.col("text"))).alias("own"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.4, id_col: str = "doc_id", **names) -> DataFrame:
    """A row for each document and benchmark item that it holds.

    ``covered`` of the item's ``tokens`` lie in windows that the document has too, at least the
    share ``coverage`` of them.  A window with placeholders counts where the values at its shift, the
    distance between item and document, map one to one, however they look at other shifts; a window without
    placeholders always does, and ``literal`` tokens lie in those.  ``slots`` placeholders were compared, and
    ``consistent`` says whether some shift was sound, or had none.

    A window with fewer than four tokens that are no placeholders is looked for with its values, as are items of
    fewer than five tokens, whole; so a verbatim copy is found whatever the item is made of.
    Items that are re-parameterisations of each other, with equal values at the same places, are one, of the
    smallest id.  Null and empty texts hold nothing and items like that are in no document.  Rows that
    repeat an id are judged one by one and the fullest match is reported; rows without an id are not.
    A text is handled whole by one task, with time in proportion to it.
    """
    facts = ["covered", "literal", "slots", "consistent", "tokens"]
    return (leaking_rows(docs, benchmark, coverage, id_col, **names)
            .groupBy("doc_id", "item_id").agg(F.max(F.struct(*facts)).alias("best"))
            .select("doc_id", "item_id", *(f"best.{c}" for c in facts)))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows, with all their columns, that hold no benchmark item.

    Rows without an id stay.  Of rows that share an id only those go whose own text holds one.
    """
    leaks = stage(leaking_rows(docs, benchmark, id_col=id_col, text_col=text_col, **settings).select("doc_id", "row").distinct(), "leaks")
    theirs = leaks.toDF("_leaking_id", "_leaking_row")
    same = (docs[id_col] == theirs["_leaking_id"]) & (F.xxhash64(docs[text_col]) == theirs["_leaking_row"])
    return docs.join(theirs, same, "left_anti")
