"""Document fingerprints by winnowing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltgate.sources.staging import Staging

PRIME = (1 << 31) - 1
BASE = 1_000_003
LOW = (1 << 32) - 1


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _shifted(a: Column, by: int) -> Column:
    return F.slice(a, by + 1, F.size(a))


def gram_hashes(text: Column, k: int) -> Column:
    """Karp-Rabin hashes of the k-grams of words, in order.

    A gram's hash is the polynomial of its words' hashes, modulo a prime; it comes from
    the hashes of its two parts, so that a gram of k words takes about log k steps. A
    text of fewer words has one gram, all its words; one without words has none.
    """
    words = F.filter(F.split(F.lower(text), "[ \\t-\\r]+"), lambda w: w != "")
    single = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME)))

    def grams(one: Column) -> Column:
        size, made = 1, one
        for bit in bin(k)[3:]:  # doubled, and one word more where k has a bit
            made, size = _joined(made, size, made, size), 2 * size
            if bit == "1":
                made, size = _joined(made, size, one, 1), size + 1
        whole = F.aggregate(one, F.lit(0).cast("long"), lambda x, y: (x * BASE + y) % PRIME)
        return (
            F.when(F.size(one) == 0, F.slice(one, 1, 0))
            .when(F.size(one) < k, F.array(whole))
            .otherwise(F.slice(made, 1, F.greatest(F.size(one) - k + 1, F.lit(0))))
        )

    return _let(single, grams)


def _joined(a: Column, a_size: int, b: Column, b_size: int) -> Column:
    """Hashes of the grams of a followed by those of b. Behind the end they mean nothing."""
    shift = pow(BASE, b_size, PRIME)
    return _let(
        a,
        lambda x: F.zip_with(
            x, _shifted(b if b is not a else x, a_size), lambda p, q: (p * shift + F.coalesce(q, F.lit(0))) % PRIME
        ),
    )


def winnow(text: Column, k: int, window: int) -> Column:
    """Selected grams of a text, as hash * 2**32 + (2**32 - 1 - position), in order.

    Of every ``window`` grams in a row the least hash is selected, the rightmost of
    equals: with the position counted down in the low bits that is the least number.
    Any run of ``window + k - 1`` words that two texts share holds a gram that both
    select; a shorter text selects its least gram.
    """
    marked = F.transform(gram_hashes(text, k), lambda h, i: h * (LOW + 1) + (F.lit(LOW) - i))

    def least(grams: Column) -> Column:
        made, width = grams, 1
        while width < window:
            step = min(width, window - width)
            made = _least_of(made, step)
            width += step
        # least() skips the missing, so the first size - window + 1 are whole windows.
        whole = F.greatest(F.size(grams) - window + 1, F.least(F.size(grams), F.lit(1)))
        return F.array_distinct(F.slice(made, 1, whole))

    return _let(marked, least)


def _least_of(a: Column, step: int) -> Column:
    """The less of each element and the one ``step`` behind it."""
    return _let(a, lambda x: F.zip_with(x, _shifted(x, step), lambda p, q: F.least(p, q)))


def hashes(selected: Column) -> Column:
    return F.transform(selected, lambda s: F.shiftrightunsigned(s, 32))


def positions(selected: Column) -> Column:
    return F.transform(selected, lambda s: F.lit(LOW) - s.bitwiseAND(F.lit(LOW)))


def as_string(selected: Column) -> Column:
    """The selected hashes in text order, each eight hexadecimal digits."""
    return F.array_join(F.transform(selected, lambda s: F.lpad(F.hex(F.shiftrightunsigned(s, 32)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the hashes of both that are in each; 1 for two empty fingerprints."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def _identity(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, text, n_chars): equal doc_id and text make one ``_row``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)
    return docs.select(
        F.unhex(F.sha2(named, 256)).alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.char_length(text).cast("long").alias("n_chars"),
    )


def followers(rows: DataFrame, staging: Staging) -> DataFrame:
    """(_row, doc_id, n_chars, _next) of each distinct row: the row of the next doc_id, after the
    last the first. Rows are dealt out by ranges; each part's last row is followed by
    the first of the next part, of which there are as many as parts."""
    ranged = staging.table(
        rows.select("doc_id", "_row", "n_chars")
        .distinct()
        .repartitionByRange("doc_id", "_row")
        .withColumn("_part", F.spark_partition_id()),
        "ranged-rows",
    )
    order = F.struct("doc_id", "_row")
    firsts = ranged.groupBy("_part").agg(F.min(order).alias("f"))
    by_part = Window.orderBy("_part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select(
        "_part",
        F.coalesce(F.lead("f").over(by_part), F.first("f").over(whole))["_row"].alias("_after"),
    )
    inside = Window.partitionBy("_part").orderBy("doc_id", "_row")
    return staging.table(
        ranged.withColumn("_lead", F.lead("_row").over(inside))
        .join(after, "_part")
        .select("_row", "doc_id", "n_chars", F.coalesce("_lead", "_after").alias("_next")),
        "followers",
    )


def fingerprint_documents(docs: DataFrame, staging: Staging, k: int = 5, window: int = 8) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_chars, edited, selected, edited_selected,
    near_edited, near_next).

    ``edited`` is the text with its last quarter replaced by as much of the beginning of
    the next document. Documents are ordered by doc_id, NULL first, rows of one doc_id
    by a hash of their text; rows equal in both are one document and get the same
    result. A NULL text is empty. A single document is followed by itself. An empty
    table gives no rows; other columns are ignored.

    Texts are shuffled once: both joins read (_row, text) by row, so that Spark reuses
    the exchange. The next document's row sends its beginning and its hashes to the row
    before, together with what else that row's result needs.
    """
    rows = _identity(docs)
    to = followers(rows, staging).withColumnRenamed("_row", "_to")
    texts = rows.select("_row", "text")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    sent = (
        texts.join(to, texts["_row"] == to["_next"])
        .select(
            "_to",
            "doc_id",
            "n_chars",
            F.substring("text", F.lit(1), quarter).alias("_begin"),
            F.array_distinct(hashes(winnow(F.col("text"), k, window))).alias("_next_hashes"),
        )
        .dropDuplicates(["_to"])
    )
    kept = F.col("n_chars").cast("int") - quarter
    edited = F.concat(F.substring("text", F.lit(1), kept), "_begin")
    joined = (
        texts.join(sent, texts["_row"] == sent["_to"])
        .select("doc_id", "n_chars", "text", edited.alias("edited"), "_next_hashes")
        .select(
            "doc_id", "n_chars", "edited", "_next_hashes",
            winnow(F.col("text"), k, window).alias("selected"),
            winnow(F.col("edited"), k, window).alias("edited_selected"),
        )
    )
    own, other = hashes(F.col("selected")), hashes(F.col("edited_selected"))
    return joined.select(
        "doc_id", "n_chars", "edited", "selected", "edited_selected",
        likeness(own, other).alias("near_edited"),
        likeness(own, F.col("_next_hashes")).alias("near_next"),
    )
