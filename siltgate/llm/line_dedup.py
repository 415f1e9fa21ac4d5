"""Removal of repeated line chunks, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import maybe_in
from siltgate.sources.staging import Staging

LINE = "[^.!?\\n]*+[.!?\\n]++|[^.!?\\n]++"
BLANKS = " \t\r\n"
MARKED, ALONE = 60, 100  # characters from which a line is a boundary, and a chunk of its own
LEAST = 32  # characters of a chunk's outer lines: shorter ones repeat by chance
REACH = 4  # lines on either side of a chunk that are compared
LENGTH = 127  # the bits of a line's hash that hold its length, or that it is longer


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lines(text: Column) -> Column:
    """A text's lines, cut behind runs of line breaks and sentence ends; joined, they are
    the text."""
    return F.regexp_extract_all(text, F.lit(LINE), F.lit(0))


def trimmed(units: Column) -> Column:
    return F.transform(units, lambda u: F.btrim(u, F.lit(BLANKS)))


def line_hashes(units: Column) -> Column:
    """Hashes of trimmed lines whose lowest bits tell their length."""

    def hashed(u: Column) -> Column:
        return F.xxhash64(u).bitwiseAND(F.lit(~LENGTH)) + F.least(F.length(u), F.lit(LENGTH))

    return F.transform(units, hashed)


def _length(h: Column) -> Column:
    return h.bitwiseAND(F.lit(LENGTH))


def chunk_spans(h: Column) -> Column:
    """(s, e, chunk) of each chunk: its first and last line and a hash.

    A line is a boundary if the rolling hash over it and the next line is not divisible
    by 3, or if it is long; so are a text's first and last line. A chunk goes from one
    boundary to the next, both included, and a very long line is one too. Boundaries
    depend on two lines only, whatever stands around them. Chunks of little text are
    left out. The hash takes in the chunk's first two lines, its last and its size; bytes
    are compared later.
    """
    last = F.size(h) - 1

    def is_boundary(i: Column) -> Column:
        here = F.get(h, i)
        rolled = F.pmod(F.xxhash64(here, F.get(h, i + 1)), F.lit(3))
        return (i == 0) | (i == last) | (_length(here) >= MARKED) | (rolled > 0)

    def span(s: Column, e: Column, *of: Column) -> Column:
        return F.struct(s.alias("s"), e.alias("e"), F.xxhash64(*of).alias("chunk"))

    def chunk(s: Column, e: Column) -> Column:
        return span(s, e, F.get(h, s), F.get(h, s + 1), F.get(h, e), e - s)

    marks = F.filter(F.sequence(F.lit(0), last), is_boundary)
    between = _let(
        marks,
        lambda m: F.zip_with(F.slice(m, F.lit(1), F.size(m) - 1), F.slice(m, F.lit(2), F.size(m) - 1), chunk),
    )
    alone = F.filter(F.sequence(F.lit(0), last), lambda i: _length(F.get(h, i)) >= ALONE)

    def is_told(c: Column) -> Column:
        first, second, end = (_length(F.get(h, i)) for i in (c["s"], c["s"] + 1, c["e"]))
        return first + end + F.when(c["e"] > c["s"] + 1, second).otherwise(0) >= LEAST

    return F.concat(F.filter(between, is_told), F.transform(alone, lambda i: span(i, i, F.get(h, i))))


def _shown(text: Column, spans: Column, most: int) -> Column:
    """What is compared of each chunk of a text: the SHA-256 of its trimmed lines, hashes of
    the lines on either side, nearest first, and its weight in words and characters.
    Neighbouring chunks share a line, which counts for the one that it ends; ``head`` has
    the words of the first line. Words are only compared with ``most``, so counts end there.
    ``size`` is the text's, told here so that no chunk has to carry the text."""
    blank, word = "[ \\t-\\r]", "[^ \\t-\\r]"
    enough = f"^{blank}*+(?:{word}++{blank}++){{{max(most, 1) - 1}}}{word}"

    def count(text: Column) -> Column:
        return F.when(text.rlike(enough), max(most, 1)).otherwise(F.regexp_count(text, F.lit(f"{word}+")))

    def shown(t: Column, h: Column, size: Column, c: Column) -> Column:
        s, e = c["s"], c["e"]
        own = (s == 0) | (s == e)  # else the first line counts for the chunk before
        before = F.slice(h, F.greatest(s - REACH, F.lit(0)) + 1, F.least(s, F.lit(REACH)))

        def told(whole: Column, rest: Column) -> Column:
            return F.struct(
                size.alias("size"),
                s.alias("s"),
                e.alias("e"),
                F.unhex(F.sha2(whole, 256)).alias("bytes"),
                F.reverse(before).alias("before"),
                F.slice(h, e + 2, F.lit(REACH)).alias("after"),
                count(rest).alias("words"),
                F.when(own, 0).otherwise(count(F.get(t, s))).alias("head"),
                F.when(s == e, 0).otherwise(F.length(rest)).alias("chars"),
            )

        def halves(whole: Column) -> Column:
            rest = F.when(own, whole).otherwise(F.array_join(F.slice(t, s + 2, e - s), "\n"))
            return _let(rest, lambda r: told(whole, r))

        return _let(F.array_join(F.slice(t, s + 1, e - s + 1), "\n"), halves)

    def all_shown(t: Column) -> Column:
        known = F.struct(F.transform(t, lambda x: F.xxhash64(x)).alias("h"), F.length(text).alias("size"))
        return _let(known, lambda k: F.transform(spans, lambda c: shown(t, k["h"], k["size"], c)))

    return _let(trimmed(lines(text)), all_shown)


def _alike(mine: Column, theirs: Column) -> Column:
    """How many of the first elements of two short lists are equal."""
    equal = F.zip_with(mine, theirs, lambda a, b: F.coalesce(a == b, F.lit(False)))
    differs = F.array_position(equal, F.lit(False))
    return F.when(differs == 0, F.size(mine)).otherwise(differs - 1).cast("int")


def _begin() -> Column:
    """Where a chunk's stretch begins: at its farthest line before the chunk that is alike
    and not blank, else at the chunk, whose first line is left out if it is blank. So
    the line break before a passage stays."""
    blank = F.xxhash64(F.lit(""))
    near = F.slice(F.col("before"), F.lit(1), _alike(F.col("before"), F.col("_first.before")))
    reach = F.coalesce(F.array_max(F.transform(near, lambda x, i: F.when(x != blank, i + 1))), F.lit(0))
    starts_blank = (F.col("head") == 0) & (F.col("s") > 0) & (F.col("s") < F.col("e"))
    return F.when((reach == 0) & starts_blank, F.col("s") + 1).otherwise(F.col("s") - reach)


def _repeated_stretches(places: DataFrame, staging: Staging, least_words: int, copies: float | None) -> DataFrame:
    """(_doc, _text, _spans, _copy): the lines that a text repeats, from places of chunks."""
    at = F.struct("_doc", "_text", "s")
    firsts = places.groupBy("bytes").agg(
        F.min(F.struct("_doc", "_text", "s", "e", "before", "after", "size")).alias("_first"), F.max(at).alias("_last")
    )
    known = F.struct("_first._doc", "_first._text", "_first.s")
    firsts = staging.table(
        firsts.filter(known != F.col("_last")).select(F.col("bytes").alias("_bytes"), "_first"), "first-places"
    )
    met = places.join(firsts, F.col("bytes").eqNullSafe(F.col("_bytes"))).filter(at != known)
    same = (F.col("_first._doc") == F.col("_doc")) & (F.col("_first._text") == F.col("_text"))
    begin = _begin()
    met = met.select(
        "_doc",
        "_text",
        F.col("_first._doc").alias("_doc0"),
        F.col("_first._text").alias("_text0"),
        (F.col("s") - F.col("_first.s")).alias("_shift"),
        # A stretch that overlaps its own first place leaves that alone.
        F.when(same, F.greatest(begin, F.col("_first.e") + 1)).otherwise(begin).alias("s"),
        (F.col("e") + _alike(F.col("after"), F.col("_first.after"))).alias("e"),
        F.struct("s", "e", "head", "words", "chars").alias("_chunk"),
        F.greatest("size", "_first.size").alias("_size"),
    )
    stretches = (
        met.filter("s <= e")
        .groupBy("_doc", "_text", "_doc0", "_text0", "_shift")
        .agg(
            F.collect_set(F.struct("s", "e")).alias("_parts"),
            F.collect_set("_chunk").alias("_chunks"),
            F.max("_size").alias("_size"),
        )
    )

    def total(field: str) -> Column:
        return F.aggregate("_chunks", F.lit(0).cast("long"), lambda a, c: a + c[field])

    words = total("words") + F.array_min("_chunks")["head"]
    if copies is None:
        is_copy = F.lit(False)
    else:
        # Equal texts may have less in chunks than that: tiny chunks are no anchors.
        is_like = (F.col("_text0") == F.col("_text")) | (total("chars") >= F.lit(copies) * F.col("_size"))
        is_copy = (F.col("_doc0") != F.col("_doc")) & is_like
    return (
        stretches.filter(words >= least_words)
        .select("_doc", "_text", "_parts", is_copy.alias("_copy"))
        .groupBy("_doc", "_text")
        .agg(F.flatten(F.collect_list("_parts")).alias("_spans"), F.max("_copy").alias("_copy"))
    )


def remove_repeated_chunks(
    docs: DataFrame, staging: Staging, least_words: int = 8, leave_copies: float | None = None
) -> DataFrame:
    """``docs`` with two columns more and ``text`` without the chunks of lines that occur
    earlier: ``lines_removed`` and ``chars_removed``.

    Lines end at runs of line breaks and sentence ends; blanks at their ends don't count.
    Chunks are told by ``chunk_spans``. Of a chunk that occurs repeatedly, within one text or
    several, the first occurrence stays: the least doc_id (NULL first), then the least
    place. Every other one, and up to ``REACH`` lines on either side of it that are the
    same beside the first, is part of a stretch that repeats one earlier text at one
    distance; blank lines at its beginning are not. Stretches of at least ``least_words`` words go; shorter ones may be chance. A
    stretch never takes lines from the first place of a chunk it repeats. Lines that
    stay are left as they are. Texts are judged as they come, not as edited.

    With ``leave_copies``, a document of which a stretch has at least that share of its
    own characters and of the earlier document's, whichever is longer, is a near copy
    of that document and is left whole, for a later stage that chooses among copies. So
    is a document whose text is the earlier one's, however short its lines are.

    A NULL text stays NULL, an empty one empty. Rows of equal doc_id and text count as one
    document and get the same text. Extra columns pass through, whatever their names, but for
    columns called as the two new ones, which these replace; an empty table stays empty.

    Chunks of all texts are told once and stored as numbers. Their hashes are counted with
    map-side folding. A Bloom filter of bounded size, made of the repeated ones, leaves the
    texts that have some; these are shuffled to meet their chunks, of which the bytes,
    told by SHA-256, are compared. The first place of a chunk goes to the others in a
    null-safe join of two stored tables, so that a hot chunk's places can be split. Spans
    are gathered by document and meet its text.
    """
    columns = [c for c in docs.columns if c not in ("lines_removed", "chars_removed")]
    keys = ["_doc", "_text"]
    named = docs.select(
        F.struct(*columns).alias("_in"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_doc"),
        F.xxhash64("text").alias("_text"),
    )
    body = F.coalesce(F.col("_in")["text"], F.lit(""))
    full = named.filter(F.col("_in")["text"] != "").select(*keys, body.alias("_body"))
    spans = _let(line_hashes(trimmed(lines(F.col("_body")))), chunk_spans)
    chunked = staging.table(full.select(*keys, spans.alias("_spans")), "chunks")
    counted = chunked.select(F.explode("_spans.chunk").alias("chunk")).groupBy("chunk").count()
    repeated = staging.table(counted.filter("count > 1").select("chunk"), "repeated-chunks")
    every = chunked.select(*keys, F.inline("_spans"))
    hits = maybe_in(every, "chunk", repeated, "chunk", repeated.count()).filter("_possible")
    hits = staging.table(
        hits.groupBy(*keys).agg(F.collect_set(F.struct("s", "e")).alias("_spans")), "chunk-hits"
    )
    texts = _of_owners(full, hits, keys)[0].join(_renamed(hits, keys), _same(keys))
    shown = _shown(F.col("_body"), F.col("_spans"), least_words)
    folder = staging.folder("chunk-places")
    texts.select(*keys, F.inline(shown)).write.option("compression", "zstd").parquet(folder)
    places = docs.sparkSession.read.parquet(folder)
    found = staging.table(_repeated_stretches(places, staging, least_words, leave_copies), "chunk-spans")
    found = found.filter("NOT _copy").drop("_copy")

    def edited(u: Column) -> Column:
        gone = F.array_distinct(F.flatten(F.transform("_spans", lambda c: F.sequence(c["s"], c["e"]))))

        def rest(out: Column) -> Column:
            kept = F.array_except(F.sequence(F.lit(0), F.size(u) - 1), out)
            text = F.array_join(F.transform(kept, lambda i: F.get(u, i)), "")
            return F.struct(F.size(out).cast("long").alias("n"), text.alias("text"))

        return _let(gone, rest)

    owners, others = _of_owners(named, found, keys)
    new = F.when(F.col("_spans").isNotNull(), _let(lines(F.col("_in")["text"]), edited))
    met = owners.join(_renamed(found, keys), _same(keys), "left").select("_in", new.alias("_new"))
    kept = others.select("_in", F.lit(None).cast(met.schema["_new"].dataType).alias("_new"))
    applies = F.col("_new").isNotNull()
    text = F.when(applies, F.col("_new")["text"]).otherwise(F.col("_in")["text"])
    lost = F.char_length(F.col("_in")["text"]) - F.char_length(F.col("_new")["text"])
    return met.union(kept).select(
        *[(text if c == "text" else F.col("_in")[c]).alias(c) for c in columns],
        F.when(applies, F.col("_new")["n"]).otherwise(F.lit(0)).cast("long").alias("lines_removed"),
        F.when(applies, lost).otherwise(F.lit(0)).cast("long").alias("chars_removed"),
    )


def _of_owners(rows: DataFrame, found: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that may own one of the stored lists, and those that surely don't."""
    owners = found.select(F.xxhash64(*keys).alias("_owner"))
    marked = maybe_in(rows.withColumn("_key", F.xxhash64(*keys)), "_key", owners, "_owner", owners.count())
    return marked.filter("_possible").drop("_key"), marked.filter("NOT _possible").drop("_key")


def _renamed(found: DataFrame, keys: list[str]) -> DataFrame:
    return found.select(*[F.col(k).alias(f"{k}_") for k in keys], "_spans")


def _same(keys: list[str]) -> Column:
    first, second = (F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys)
    return first & second
