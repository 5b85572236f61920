"""Document fingerprints by consistent weighted sampling.

A text's terms are its words, weighted by how often they occur.  For a term of weight w, hashes
of the term alone give r and c from Gamma(2, 1) and b from [0, 1), and then

    t = floor(log(w) / r + b),   log(a) = log(c) - r * (t - b) - r

The term with the least a is the sample, together with its t.  Two texts draw the same sample
with the probability of their generalised Jaccard similarity, the sum of the terms' smaller weights
over that of the larger ones.  Terms are dealt to ``bins`` by a hash, and each bin is sampled
``samples`` times by its terms alone; one bin, the default, is the plain scheme.  More bins give each
bin the same say, however little of the text's weight it holds.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.session import stage

SAMPLES = 64
#: Samples of a text that are drawn in one pass over its terms, each the least of a column.
_PASS = 8
#: Terms this many times farther off than the expected least are given up on at first, see ``_all_sampled``.
_WITHIN = 12.0
_FINE = 1 << 23  # steps of log(a), which lies between -128 and 128
_CODE = (1 << 16) - 1


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x09-\x0D ]+"), "")


def _halves(term: Column, sample: Column, which: int) -> tuple[Column, Column]:
    """Two numbers between 0 and 1, both excluded, by hash alone."""
    bits = F.xxhash64(term, sample * 4 + which)
    return tuple((half.cast("double") + 0.5) * F.lit(2.0 ** -32)
                 for half in (F.shiftrightunsigned(bits, 32), bits.bitwiseAND((1 << 32) - 1)))


def _draw(term: Column, sample: Column, log_weight: Column, slot: Column,
          most: tuple[Column, Column] | None = None) -> Column:
    """log(a) and the sample's code in one number whose least is the draw; null without a weight.

    Given ``most``, a bound times the weight and the bound's logarithm, it is also null where a is greater.  As t - b is more than log(w) / r - 1, a is
    at least c * exp(-r) / w = -log(u3 * u4) * u1 * u2 / w, and -log(x) at least 1 - x: so most terms, which
    are far from being the least, need no logarithm.  Both tests leave out no term that is less than one they let in.
    """
    u1, u2 = _halves(term, sample, 0)
    u3, u4 = _halves(term, sample, 1)
    r, c = -F.log(u1 * u2), -F.log(u3 * u4)
    b = _halves(term, sample, 2)[0]
    t = F.floor(log_weight / r + b)
    a = F.log(c) - r * (t - b) - r
    steps = F.floor(F.greatest(F.lit(-127.0), F.least(F.lit(127.0), a)) * _FINE).cast("bigint")
    # An odd factor, so neighbouring t of a term never share a code.
    code = F.shiftleft(slot.cast("bigint"), 16).bitwiseOR(
        F.shiftrightunsigned(term, 24).bitwiseXOR(t * 40503).bitwiseAND(_CODE))
    drawn = F.shiftleft(steps, 32) + code
    if most is None:
        return drawn
    # A little less than what the first test leaves out, beyond any rounding.
    near = F.when(a <= most[1] - 1e-5, drawn)
    return F.when((1 - u3 * u4) * (u1 * u2) <= most[0], near)


def _all_sampled(texts: DataFrame, key: list[str], text_cols: list[str], bins: int, samples: int,
                 within: float | None = None) -> DataFrame:
    """``key``, the draws of each of ``text_cols`` under its name, where any of them has a word, and its words' number.

    What depends on term and sample alone is worked out once for all texts of a row.  The least a of a
    text of n words is exponentially distributed with rate n.  ``within`` gives up on terms whose a is
    more than that many times 1 / n: then a draw is missing with the probability exp(-within).
    """
    if len(text_cols) > 2:
        raise ValueError("two texts of a row at most")
    split = texts.select(*key, *(words(F.col(c)).alias(f"words{k}") for k, c in enumerate(text_cols)))
    sizes = [F.size(f"words{k}").cast("long") for k in range(len(text_cols))]
    sizes = sizes[0] if len(sizes) == 1 else sizes[0] + F.shiftleft(sizes[1], 32)
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("which"), F.col(f"words{k}").alias("words"))
                               for k in range(len(text_cols)))))
    exploded = (split.select(*key, sizes.alias("_sizes"), each.alias("one"))
                .select(*key, "_sizes", "one.which", F.explode("one.words").alias("word")))
    # Counts of both texts share one long, and so do their sizes, which all rows of a key know: there is a row here
    # for every word of every text.
    low = (1 << 32) - 1
    terms = exploded.groupBy(*key, F.xxhash64("word").alias("term")).agg(
        F.sum(F.when(F.col("which") == 0, F.lit(1)).otherwise(F.lit(1 << 32))).alias("_counts"), F.max("_sizes").alias("_sizes"))

    def of(packed: str, k: int) -> Column:
        value = F.shiftrightunsigned(packed, 32) if k else F.col(packed).bitwiseAND(low)
        return F.nullif(value, F.lit(0)).cast("double")

    logs = [f"log{k}" for k in range(len(text_cols))]
    facts = [c for k, name in enumerate(logs) for c in (
        F.log(of("_counts", k)).alias(name), (F.lit(within or 1.0) * of("_counts", k) / of("_sizes", k)).alias(f"bound{k}"),
        F.log(F.lit(within or 1.0) / of("_sizes", k)).alias(f"limit{k}"))]
    terms = terms.select(*key, "term", "_sizes", *facts)
    together = max(k for k in range(1, _PASS + 1) if samples % k == 0)
    terms = terms.withColumn("first", F.explode(F.sequence(F.lit(0), F.lit(samples - 1), F.lit(together))))
    bin_ = F.pmod(F.col("term"), F.lit(bins))
    drawn = terms.groupBy(*key, bin_.alias("bin"), "first").agg(*(
        F.min(_draw(F.col("term"), F.col("first") + k, F.col(name), bin_ * samples + F.col("first") + k,
                    (F.col(f"bound{j}"), F.col(f"limit{j}")) if within else None)).alias(f"{name}_{k}")
        for k in range(together) for j, name in enumerate(logs)), F.max("_sizes").alias("_sizes"))

    def mine(name):
        draws = F.array_compact(F.array(*(f"{name}_{k}" for k in range(together))))
        return F.transform(draws, lambda d: d.bitwiseAND((1 << 32) - 1).cast("int"))

    whole = drawn.groupBy(*key).agg(
        *(F.sort_array(F.flatten(F.collect_list(mine(name)))).alias(c) for name, c in zip(logs, text_cols)),
        F.max("_sizes").alias("_sizes"))
    return whole.select(*key, *text_cols, *(F.coalesce(of("_sizes", k), F.lit(0.0)).alias(f"{c}_words")
                                            for k, c in enumerate(text_cols)))


def sampled(texts: DataFrame, key: list[str], text_col: str, bins: int = 1, samples: int = SAMPLES) -> DataFrame:
    """``key`` and ``draws``, the sorted slots and codes of each text; none for a text without words.

    ``key`` must tell texts apart.  If rows are partitioned by some of it already, they are
    not moved.
    """
    return _all_sampled(texts, key, [text_col], bins, samples).select(*key, F.col(text_col).alias("draws"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the slots of either that hold the same sample; two without any are alike."""
    def slots(draws):
        return F.transform(draws, lambda d: F.shiftright(d, 16))

    both = F.size(F.array_intersect(slots(a), slots(b)))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_text(draws: Column) -> Column:
    """Six hex digits for each slot in use, by slot."""
    return F.array_join(F.transform(draws, lambda d: F.lpad(F.lower(F.hex(d)), 6, "0")), "")


def successors(rows: DataFrame, order: list[str], key: list[str]) -> DataFrame:
    """``rows`` with ``next_`` before the names of ``key``: the key of the next row, the last one's the first's.

    Rows are dealt into ranges; only one row for each range is looked at together.
    """
    places = [*order, *key]
    ranged = stage(rows.repartitionByRange(*places).withColumn("_range", F.spark_partition_id()), "ranges")
    following = Window.partitionBy("_range").orderBy(*places)
    first = (ranged.groupBy("_range").agg(F.min(F.struct(*places)).alias("_first")))
    overall = Window.orderBy("_range")
    first = first.select("_range", F.coalesce(
        F.lead("_first").over(overall),
        F.first("_first").over(overall.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_after"))
    after = ranged.withColumn("_next", F.lead(F.struct(*places)).over(following)).join(first, "_range")
    return after.select(*rows.columns, *(F.coalesce(f"_next.{k}", f"_after.{k}").alias(f"next_{k}") for k in key))


def edit_fingerprints(docs: DataFrame, bins: int = 1, samples: int = SAMPLES, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many of the
    next document's, by ascending id; the last document's next is the first.  Null
    texts are empty ones.  Null ids come first, and documents of one id go by a hash of their
    text.  Rows that repeat id and text are one document and are returned once.  Texts
    without words have an empty fingerprint and are alike.
    """
    key = ["r1", "r2"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = (docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
            .select(F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64("text", F.lit(7), "doc_id").alias("r2"),
                    "doc_id", "text"))
    order = stage(successors(rows.select("doc_id", *key, F.length("text").cast("bigint").alias("n_chars")).distinct(),
                             ["doc_id"], key)
                  .withColumn("taken", F.floor(F.col("n_chars") / 4).cast("int")), "fingerprint-order")
    one = rows.dropDuplicates(key).select(*key, "text")

    def drawn(order: DataFrame, one: DataFrame, within: float | None) -> DataFrame:
        # What the next document lends to the one before it.
        lent = (order.select(F.col("r1").alias("o1"), F.col("r2").alias("o2"), "taken",
                             F.col("next_r1").alias("r1"), F.col("next_r2").alias("r2"))
                .join(one, key).select(F.col("o1").alias("r1"), F.col("o2").alias("r2"),
                                       F.substr("text", F.lit(1), "taken").alias("head")))
        whole = (one.join(order, key).join(lent, key)
                 .withColumn("edited", F.concat(F.substr("text", F.lit(1), (F.col("n_chars") - F.col("taken")).cast("int")),
                                                F.col("head"))))
        facts = whole.select(*key, "doc_id", "n_chars", "next_r1", "next_r2",
                             F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
        both = _all_sampled(whole.select(*key, F.col("text").alias("own"), F.col("edited").alias("other")), key,
                            ["own", "other"], bins, samples, within)
        none = F.array().cast("array<int>")
        return facts.join(both, key, "left").withColumns({"own": F.coalesce("own", none), "other": F.coalesce("other", none)})

    first = stage(drawn(order, one, _WITHIN if bins == 1 else None), "fingerprints")
    joined = first.drop("own_words", "other_words")
    if bins == 1:
        # The few texts that lack a draw are drawn again from all of their terms.
        missing = (((F.col("own_words") > 0) & (F.size("own") < samples))
                   | ((F.col("other_words") > 0) & (F.size("other") < samples)))
        again = stage(first.where(missing).select(*key), "fingerprints-again")
        if not again.isEmpty():
            theirs = stage(order.join(again, key, "left_semi"), "fingerprints-order")
            needed = theirs.select(*key).union(theirs.select("next_r1", "next_r2")).distinct()
            redrawn = stage(drawn(theirs, one.join(needed, key, "left_semi"), None).select(*joined.columns), "fingerprints-redrawn")
            joined = joined.join(again, key, "left_anti").unionByName(redrawn)
    after = joined.select(F.col("r1").alias("next_r1"), F.col("r2").alias("next_r2"), F.col("own").alias("next_own"))
    return joined.join(after, ["next_r1", "next_r2"]).select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))
