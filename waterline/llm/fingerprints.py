"""Document fingerprints by I-Match with randomised lexicons.

The lexicon is the band of terms that are neither common nor rare in the corpus. A document keeps
its distinct terms of the lexicon in sorted order, and each of several random subsets of the lexicon
hashes those it holds. The subsets form ``SALTS`` ladders of ``LEVELS`` steps, each step a quarter
of the one before, so that short and long documents alike have subsets with one or two of their
terms, which survive an edit elsewhere in the text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.llm.tables import same
from waterline.sources.staging import materialise

# Shares of all documents a lexicon term occurs in, and the least number of them.
LEAST_SHARE, MOST_SHARE, LEAST_DOCS = 0.005, 0.1, 2
SALTS, LEVELS = 16, 5
# A level decides on two fingerprints if so many of its subsets hold a term of either.
ENOUGH = 6
# The lexicon as bits. Documents hold D distinct terms on average, so at most D / LEAST_SHARE terms
# reach the band, whatever the size of the corpus; a term outside it that hits two set bits counts
# as one of the lexicon, in every document alike. There are 2**BITS bits, and more where the band
# has over 2**BITS / PER_TERM terms: at most 2 / PER_TERM of them are set, so a term outside the band
# counts with a probability of at most (2 / PER_TERM) ** 2, 0.31 %.
BITS, PER_TERM = 18, 36


def terms(text: Column) -> Column:
    """Hashes of the distinct terms: runs of letters and digits in lower case."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame) -> DataFrame:
    """``(term, df)`` of the terms in the band, from all documents."""
    held = docs.select(F.explode(terms(F.coalesce(F.col("text"), F.lit("")))).alias("term"))
    counts = held.groupBy("term").agg(F.count("*").alias("df"))
    total = docs.select(F.count("*").alias("n")).scalar()
    band = (F.col("df") >= F.greatest(F.lit(LEAST_DOCS), total * LEAST_SHARE)) & (F.col("df") <= F.greatest(F.lit(LEAST_DOCS), total * MOST_SHARE))
    return counts.filter(band)


def _places(term: Column, size: int) -> list[Column]:
    return [F.shiftrightunsigned(term, shift).bitwiseAND(F.lit(size - 1)) for shift in (0, 32)]


def lexicon_bits(words: DataFrame) -> bytes:
    """The lexicon as a constant: four of its bits to a byte, as many as its terms ask for."""
    words = materialise(words.select("term"), "lexicon")
    size = 1 << max(BITS, (PER_TERM * words.count() - 1).bit_length())
    bits = words.select(F.explode(F.array(*_places(F.col("term"), size))).alias("place"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    rows = bits.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(one).alias("bits")).collect()
    held = np.zeros(size >> 6, dtype="<i8")
    held[[r["word"] for r in rows]] = [r["bits"] for r in rows]
    whole = held.view(np.uint8)
    return np.stack([whole & 15, whole >> 4], axis=1).tobytes()


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), use), 0)


def _in_lexicon(term: Column, bits: Column, size: int) -> Column:
    found = F.lit(True)
    for place in _places(term, size):
        # a byte below 16 is a character of its own
        four = F.substring(bits, (F.shiftright(place, 2) + 1).cast("int"), F.lit(1)).cast("string")
        found = found & (F.getbit(F.ascii(four).cast("long"), place.bitwiseAND(F.lit(3)).cast("int")) == 1)
    return found


def fingerprint(text: Column, bits: bytes) -> Column:
    """Levels parted by ``|``, subsets by ``,``; ``-`` is a subset without a term of the text.

    A text without any term of the lexicon has the hash of the whole text instead.
    """

    def ladder(kept: Column, salt: Column) -> Column:
        def down(state: Column, level: Column) -> Column:
            def stays(term: Column) -> Column:
                drawn = F.call_function("shiftrightunsigned", F.xxhash64(term, salt), (level * 2).cast("int"))
                return drawn.bitwiseAND(F.lit(3)) == 0

            def grown(held: Column) -> Column:
                last = F.when(F.size(held) > 0, _short(held)).otherwise(F.lit("-"))
                return F.struct(held.alias("held"), F.array_append(state["out"], last).alias("out"))

            return _let(F.filter(state["held"], stays), grown)

        start = F.struct(kept.alias("held"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), start, down, lambda state: state["out"])

    def level(ladders: Column, number: int) -> Column:
        return F.array_join(F.transform(ladders, lambda steps: F.get(steps, number)), ",")

    def shown(kept: Column) -> Column:
        ladders = F.transform(F.sequence(F.lit(1), F.lit(SALTS)), lambda salt: ladder(kept, salt))
        whole = F.concat(F.lit("text:"), F.lower(F.hex(F.xxhash64(text))))
        hashed = _let(ladders, lambda all_steps: F.concat_ws("|", *[level(all_steps, i) for i in range(LEVELS)]))
        return F.when(F.size(kept) > 0, hashed).otherwise(whole)

    held = _let(F.lit(bits), lambda constant: F.array_sort(F.filter(terms(text), lambda t: _in_lexicon(t, constant, 4 * len(bits)))))
    return _let(held, shown)


def _short(held: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.xxhash64(held).bitwiseAND(F.lit(0xFFFF)))), 4, "0")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that hold a term of either text, 0 to 1.

    The sparsest level with enough such subsets decides, else the densest one. Equal fingerprints
    are alike, whatever they hold.
    """
    first, second = (F.transform(F.split(x, r"\|"), lambda level: F.split(level, ",")) for x in (a, b))

    def rate(x: Column, y: Column) -> Column:
        pairs = F.arrays_zip(x.alias("x"), y.alias("y"))
        used = F.filter(pairs, lambda p: (p["x"] != "-") | (p["y"] != "-"))
        equal = F.filter(used, lambda p: p["x"] == p["y"])
        return F.struct(F.size(used).alias("used"), F.size(equal).alias("equal"))

    rates = F.zip_with(first, second, rate)
    enough = F.filter(rates, lambda r: r["used"] >= ENOUGH)
    chosen = F.coalesce(F.get(enough, F.size(enough) - 1), F.get(rates, 0))
    both = F.contains(a, F.lit("|")) & F.contains(b, F.lit("|"))
    return F.when(a == b, F.lit(1.0)).when(both & (chosen["used"] > 0), chosen["equal"] / chosen["used"]).otherwise(F.lit(0.0))


def _before(keys: DataFrame) -> DataFrame:
    """Add the key and length of the document before each, in descending order of id.

    Keys are sorted in ranges and written with their place; neighbours meet within a range, and only
    the last key of each range goes to the next one. The first key follows the last.
    """
    ordered = keys.repartitionByRange(F.desc_nulls_last("doc_id"), F.col("hash")).sortWithinPartitions(F.desc_nulls_last("doc_id"), F.col("hash"))
    ordered = ordered.select("doc_id", "hash", "n", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"))
    ordered = materialise(ordered, "ordered")
    ends = ordered.groupBy("part").agg(F.max(F.struct("seq", "doc_id", "hash", "n")).alias("end"))
    across = Window.orderBy("part")
    last = F.last("end").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("part", F.coalesce(F.lag("end").over(across), last).alias("end"))
    within = Window.partitionBy("part").orderBy("seq")
    ordered = ordered.withColumn("own", F.lag(F.struct("seq", "doc_id", "hash", "n")).over(within)).join(ends, "part")
    found = F.coalesce("own", "end")
    return ordered.select("doc_id", "hash", "n", found["doc_id"].alias("to_id"), found["hash"].alias("to_hash"), found["n"].alias("to_n"))


def compare_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text; one row per row of ``docs``.

    The edited text has the last third of the characters replaced by as many first ones of the next
    document. Each document sends that beginning and its fingerprint to the one before it; whole
    texts move once.

    Nulls: a null text is an empty one; null ids come last in the order. Rows that repeat an id and a
    text count as one document there and get equal results; an id with several texts is ordered by
    their hash. A single document follows itself. An empty table gives no rows. Other columns of
    ``docs`` are not read.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", body.alias("text"))
    bits = lexicon_bits(lexicon(docs))

    keys = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.length("text").cast("long").alias("n"))
    routes = _before(keys.groupBy("doc_id", "hash").agg(F.max("n").alias("n")))
    texts = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text", fingerprint(F.col("text"), bits).alias("fingerprint"))
    sent = texts.join(routes, same(texts, routes, "doc_id", "hash")).select(
        texts["doc_id"], texts["hash"], "text", "fingerprint", "n", "to_id", "to_hash", "to_n"
    )
    third = (F.col("to_n") / 3).cast("int")
    beginnings = sent.select("to_id", "to_hash", F.substring("text", F.lit(1), third).alias("beginning"), F.col("fingerprint").alias("next_fingerprint"))
    beginnings = beginnings.dropDuplicates(["to_id", "to_hash"])
    own = sent.select("doc_id", "hash", "text", "fingerprint", "n")
    met = own.join(beginnings, own["doc_id"].eqNullSafe(beginnings["to_id"]) & own["hash"].eqNullSafe(beginnings["to_hash"]))
    keep = (F.col("n") - F.floor(F.col("n") / 3)).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), keep), F.col("beginning"))
    met = met.select("doc_id", F.col("n").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint")
    met = met.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", fingerprint(F.col("edited"), bits).alias("edited_fingerprint"), "next_fingerprint"
    )
    return met.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
