"""Near-duplicate lines by a deletion-neighbourhood join; DataFrame operations only.

Lines are sequences of words, which white space separates. Two lines are near if one
word inserted, deleted or replaced makes them equal, which shows in a common
variant: a line without one of its words, or the line itself. Lines whose halves occur in no other line can't be
near any, so only the others emit their variants as hashed keys. Equal variants
meet, the distance of a line and its earliest partner is verified on the words,
and a line goes if an earlier one is equal or near.

No group is ever expanded into pairs: lines that lack the same word of an equal
frame are all near each other, so each only meets the earliest of them, and a
frame that is a line itself is one line.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.scratch import materialize

#: Lines of fewer words have no near lines, as one word of them is too much: only equal ones go.
MIN_WORDS = 5
#: Bytes, estimated from counts, up to which lists of lines by document are broadcast to meet the
#: texts; beyond that the texts are shuffled.
BROADCAST_BYTES = 32 << 20
#: Keys, counted, up to which a set of them is broadcast.
BROADCAST_KEYS = 500_000


#: White space inside lines other than the space, to be read as spaces.
BLANKS = "\t\x0b\f\r"


def even(text: Column) -> Column:
    """``text`` with a space for every other white space inside lines; few texts have any."""
    some = reduce(or_, [F.contains(text, F.lit(c)) for c in BLANKS])
    return F.when(some, F.translate(text, BLANKS, " " * len(BLANKS))).otherwise(text)


def line_words(line: Column) -> Column:
    """The runs of non-blank characters of an ``even`` line."""
    return F.array_remove(F.split(line, " "), "")


def if_few(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def class_hash(ws: Column) -> Column:
    return F.xxhash64(ws)


def half_keys(ws: Column, n: Column) -> Column:
    """Hashes of the halves that a line shares with any line near it, for a partner as long or
    longer and for one shorter by a word."""
    keys = []
    for shorter in (0, 1):
        m = n - shorter
        front = F.floor(m / 2).cast("int")
        back = m - front
        keys += [F.xxhash64(F.lit("front"), m, F.slice(ws, F.lit(1), front)), F.xxhash64(F.lit("back"), m, F.slice(ws, n - back + 1, back))]
    return F.array(*keys)


def lines_of(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, line_no, h, g, halves): the lines by their hashes; those of fewer than ``min_words``
    words without halves, those without words without hashes."""
    lines = docs.select("doc_id", F.posexplode(F.split(even(F.col("text")), "\n")).alias("line_no", "line"))
    lines = lines.select("doc_id", "line_no", line_words(F.col("line")).alias("ws"))
    # Told by a null rather than a filter here, for which each line would be split twice.
    return lines.select(
        "doc_id",
        "line_no",
        F.when(F.size("ws") > 0, class_hash(F.col("ws"))).alias("h"),
        F.xxhash64(F.lit("g"), "ws").alias("g"),
        F.when(F.size("ws") >= min_words, half_keys(F.col("ws"), F.size("ws"))).alias("halves"),
    )


def first_lines(lines: DataFrame) -> DataFrame:
    """(h, g, halves, first): distinct lines and the earliest place (doc_id, line_no) of each."""
    placed = lines.select("h", "g", "halves", F.struct("doc_id", "line_no").alias("place"))
    return placed.groupBy("h", "g").agg(F.min("place").alias("first"), F.any_value("halves").alias("halves"))


def plausible_lines(firsts: DataFrame) -> DataFrame:
    """(doc_id, line_no, h): lines that share a half with another line."""
    halves = firsts.select("h", "first", F.explode(F.array_distinct("halves")).alias("half"))
    shared = materialize(halves.groupBy("half").count().filter("count > 1").select("half"), "halves")
    return halves.join(if_few(shared), "half", "left_semi").select("first.doc_id", "first.line_no", "h").distinct()


def with_line_lists(docs: DataFrame, lines: DataFrame, how: str) -> DataFrame:
    """(row, text, doc_id, lines): each row as a struct with the set of (line_no, h) that ``lines`` has of its doc_id."""
    lists = lines.groupBy(F.col("doc_id").alias("of")).agg(F.collect_set(F.struct("line_no", "h")).alias("lines"))
    lists = materialize(lists, "line-lists")
    size = lists.agg(F.count("*"), F.sum(F.size("lines"))).first()
    if size[0] * 80 + (size[1] or 0) * 40 <= BROADCAST_BYTES:
        lists = F.broadcast(lists)
    rows = docs.select(F.struct("*").alias("row"), "text", "doc_id")
    return rows.join(lists, F.col("doc_id").eqNullSafe(F.col("of")), how).drop("of")


def listed_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(place, h, ws): the words of the given lines (doc_id, line_no, h)."""
    rows = with_line_lists(docs.select("doc_id", "text"), lines, "inner")
    # Split before the lines are spread out, once for each text.
    each = rows.select("doc_id", "lines", F.split(even(F.col("text")), "\n").alias("all")).select("doc_id", "all", F.explode("lines").alias("l"))
    words = each.select(
        F.struct("doc_id", F.col("l.line_no").alias("line_no")).alias("place"),
        F.col("l.h").alias("h"),
        line_words(F.get("all", F.col("l.line_no"))).alias("ws"),
    )
    # A row that repeats a doc_id may have another line there.
    return words.filter(class_hash(F.col("ws")) == F.col("h")).dropDuplicates(["h", "place"])


def variants_of(lines: DataFrame) -> DataFrame:
    """(v, n, pos, place, h): each line without its word ``pos``, and with pos -1 the line itself."""
    hashed = lines.select("place", "h", F.transform("ws", lambda w: F.xxhash64(w)).alias("ws"))
    each = hashed.select("place", "h", "ws", F.explode(F.sequence(F.lit(-1), F.size("ws") - 1)).alias("pos"))
    n = F.size("ws")
    # Words before pos, then those after it; hashing one array after the other is hashing their words in a row.
    left = F.slice("ws", F.lit(1), F.greatest("pos", F.lit(0))), F.slice("ws", F.col("pos") + 2, n)
    length = n - F.when(F.col("pos") < 0, 0).otherwise(1)
    return each.select(F.xxhash64(*left).alias("v"), length.alias("n"), "pos", "place", "h")


def earliest_partners(variants: DataFrame) -> DataFrame:
    """(place, h, partner, partner_h): for each line with an earlier line near it, the earliest such line."""
    keys = ["v", "n"]
    shared = materialize(variants.groupBy(*keys).count().filter("count > 1").select(*keys), "variants")
    met = materialize(variants.join(if_few(shared), keys, "left_semi").withColumn("at", F.struct("place", "h")), "met")
    # Frames that lack a word at the same place: the earliest line of each.
    frames = materialize(met.filter("pos >= 0").groupBy(*keys, "pos").agg(F.min("at").alias("p")), "frames")
    replaced = met.filter("pos >= 0").join(frames, [*keys, "pos"])
    # A line that is the frame of a longer one, both ways.
    itself = materialize(met.filter("pos < 0").groupBy(*keys).agg(F.min("at").alias("p")), "itself")
    shortened = met.filter("pos >= 0").join(itself, keys)
    longer = materialize(frames.groupBy(*keys).agg(F.min("p").alias("p")), "longer")
    lengthened = met.filter("pos < 0").join(longer, keys)
    pairs = [x.select("at", "p").filter("p < at") for x in (replaced, shortened, lengthened)]
    every = pairs[0].unionByName(pairs[1]).unionByName(pairs[2])
    return every.groupBy("at").agg(F.min("p").alias("p")).select(
        "at.place", "at.h", F.col("p.place").alias("partner"), F.col("p.h").alias("partner_h")
    )


def near(a: Column, b: Column) -> Column:
    """Whether one word inserted, deleted or replaced, or none, makes two word arrays equal."""
    n, m = F.size(a), F.size(b)
    least = F.least(n, m)
    differs = F.filter(F.sequence(F.lit(0), least), lambda i: (i == least) | (F.get(a, i) != F.get(b, i)))
    front = F.get(differs, F.lit(0))
    return (F.abs(n - m) <= 1) & (
        F.slice(a, front + 1 + F.when(n >= m, 1).otherwise(0), n)
        == F.slice(b, front + 1 + F.when(m >= n, 1).otherwise(0), m)
    )


def near_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(doc_id, line_no, h): first places of distinct lines that an earlier line is near to."""
    words = listed_lines(docs, materialize(plausible_lines(firsts), "plausible"))
    words = materialize(words, "line-words")
    pairs = earliest_partners(materialize(variants_of(words), "line-variants"))
    own = pairs.join(words.select("place", "h", F.col("ws").alias("a")), ["place", "h"])
    other = words.select(F.col("place").alias("partner"), F.col("h").alias("partner_h"), F.col("ws").alias("b"))
    verified = own.join(other, ["partner", "partner_h"]).filter(near(F.col("a"), F.col("b")))
    return verified.select("place.doc_id", "place.line_no", "h")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, line_no, h): the lines to remove."""
    lines = materialize(lines_of(docs, min_words), "lines").filter("h IS NOT NULL")
    firsts = materialize(first_lines(lines), "first-lines")
    near_ones = materialize(near_lines(docs, firsts), "near-lines")
    kept = firsts.select("first.doc_id", "first.line_no", "h")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["line_no"] == b["line_no"]) & (a["h"] == b["h"])
    kept = kept.join(near_ones, same(kept, near_ones), "left_anti")
    every = lines.select("doc_id", "line_no", "h")
    return every.join(kept, same(every, kept), "left_anti")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the column ``text`` rid of its repeated lines, and ``lines_removed`` added.

    A line with words goes if a line earlier in the order of (doc_id, line number)
    has the same words, and one of at least ``min_words`` also if such a line of at
    least ``min_words`` is one word off, whether that line stays or not. Blank lines
    stay. Null texts stay null, texts without repeated lines are unchanged,
    and rows without doc_id come first. Rows that repeat a doc_id count as one
    document: equal lines at equal places of them are not repeats of each other.
    Other columns of ``docs`` pass through. An empty table gives an empty one. A line
    of very many words costs the square of them, as it has a variant for each.
    """
    dropped = materialize(repeated_lines(docs, min_words).distinct(), "dropped-lines")
    rows = with_line_lists(docs, dropped, "left")
    numbered = F.transform(
        F.arrays_zip(F.split("text", "\n").alias("line"), F.split(even(F.col("text")), "\n").alias("words")),
        lambda x, i: F.struct(i.alias("line_no"), x["line"].alias("line"), x["words"].alias("words")),
    )
    # The line's number is compared first: only a line that is listed is hashed.
    dropped_here = lambda x: F.exists(
        "lines", lambda d: (d["line_no"] == x["line_no"]) & (d["h"] == class_hash(line_words(x["words"])))
    )
    kept = F.filter(numbered, lambda x: ~dropped_here(x))
    rows = rows.withColumn("kept", F.when(F.col("lines").isNotNull(), kept))
    removed = F.when(F.col("kept").isNotNull(), F.size(F.split("text", "\n")) - F.size("kept")).otherwise(0)
    text = F.when(F.col("kept").isNotNull(), F.array_join(F.col("kept.line"), "\n")).otherwise(F.col("text"))
    columns = [text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return rows.select(*columns, removed.alias("lines_removed"))
