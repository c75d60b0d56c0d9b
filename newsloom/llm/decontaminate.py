"""Benchmark decontamination with a positional inverted index over the training rows.

Test items are cut into windows of consecutive words. The training rows are read
once to count the items' terms, which drops every window with a term that never
occurs, and once more to store postings (row, term, position) of the rarest terms
of the windows that remain. A window's candidates are its rarest term's postings
moved back by the term's offset, intersected with the moved lists of the next
rarest terms; the whole phrase is compared last, on the few rows with candidates.
DataFrame operations only.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.scratch import materialize

WINDOW_WORDS = 10
#: Lists that are intersected before phrases are compared.
LISTS = 3
#: Words are what lies between these characters, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Distinct terms of all items up to which their hashes (8 bytes each) are broadcast; a larger set is joined by shuffle.
BROADCAST_TERMS = 500_000


def words(text: Column) -> Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATORS), "")


def row_key(docs: DataFrame) -> Column:
    """Same for repeated rows only, up to hash collisions, which phrases are compared against."""
    return F.xxhash64("doc_id", "text")


def windows_of(items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(item_id, phrase, n): every window of ``size`` words of each item; all words of a shorter one."""
    listed = items.select("item_id", words(F.col("text")).alias("ws")).filter(F.size("ws") > 0)
    last = F.greatest(F.size("ws") - size, F.lit(0))
    each = listed.select("item_id", "ws", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    part = F.slice("ws", F.col("at") + 1, size)
    return each.select("item_id", F.array_join(part, " ").alias("phrase"), F.size(part).alias("n")).distinct()


def known_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """The ``rows`` whose term hash ``h`` is among ``terms``."""
    if terms.count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    return rows.join(terms, "h", "left_semi")


def occurrences_of_terms(docs: DataFrame) -> DataFrame:
    """(k, pos, h) for every word of every row."""
    listed = docs.select(row_key(docs).alias("k"), F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return listed.select("k", "pos", F.xxhash64("word").alias("h"))


@dataclass
class Index:
    """Windows that may occur, their rarest terms, and the stored postings of those."""

    windows: DataFrame  # (phrase, n, w)
    anchors: DataFrame  # (w, n, lists: array of (h, offset), the rarest first)
    postings: DataFrame  # (k, pos, h)


def build_index(docs: DataFrame, windows: DataFrame) -> Index:
    """Count the windows' terms in ``docs``, choose the rarest of each window and store their postings."""
    phrases = materialize(
        windows.select("phrase", "n").distinct().withColumn("w", F.xxhash64("phrase")), "windows"
    )
    spread = phrases.select("w", "n", F.posexplode(F.split("phrase", " ")).alias("offset", "word"))
    spread = spread.select("w", "n", "offset", F.xxhash64("word").alias("h"))
    vocabulary = materialize(spread.select("h").distinct(), "terms")
    counts = materialize(known_terms(occurrences_of_terms(docs), vocabulary).groupBy("h").count(), "counts")
    counted = spread.join(counts, "h")
    order = Window.partitionBy("w").orderBy("count", "offset")
    present = counted.withColumn("rank", F.row_number().over(order)).withColumn(
        "present", F.count("*").over(Window.partitionBy("w"))
    )
    rarest = present.filter((F.col("present") == F.col("n")) & (F.col("rank") <= LISTS))
    anchors = rarest.groupBy("w", "n").agg(F.sort_array(F.collect_list(F.struct("rank", "h", "offset"))).alias("lists"))
    anchors = materialize(anchors, "anchors")
    chosen = materialize(anchors.select(F.explode("lists.h").alias("h")).distinct(), "chosen")
    postings = materialize(known_terms(occurrences_of_terms(docs), chosen), "postings")
    return Index(phrases, anchors, postings)


def candidates(index: Index, slop: int = 0) -> DataFrame:
    """(k, w, n, start): places where all lists of a window meet.

    With ``slop`` the terms after the rarest may lie that many words off their
    places, in either direction: proximity matches, of which phrases are a part.
    """
    first = index.anchors.select("w", "n", "lists", F.col("lists")[0]["h"].alias("h"), F.col("lists")[0]["offset"].alias("o"))
    found = index.postings.join(first, "h").select("k", "w", "n", "lists", (F.col("pos") - F.col("o")).alias("start"))
    if slop == 0:
        found = found.filter("start >= 0")
    bin_width = 2 * slop + 1
    # Bins of positions make the tolerance an equality of one or two bins.
    postings = index.postings.select("k", "h", "pos", F.floor(F.col("pos") / bin_width).alias("bin"))
    for at in range(1, LISTS):
        rest = found.filter(F.size("lists") > at)
        place = F.col("start") + F.col("lists")[at]["offset"]
        wanted = rest.select("k", "w", "n", "lists", "start", F.col("lists")[at]["h"].alias("h"), place.alias("place"))
        if slop:
            bins = F.array_distinct(F.array(F.floor((F.col("place") - slop) / bin_width), F.floor((F.col("place") + slop) / bin_width)))
            wanted = wanted.withColumn("bin", F.explode(bins))
        else:
            wanted = wanted.withColumn("bin", F.col("place").cast("long"))
        met = wanted.join(postings, ["k", "h", "bin"]).filter(F.abs(F.col("pos") - F.col("place")) <= slop)
        met = met.select("k", "w", "n", "lists", "start")
        if slop:
            met = met.distinct()
        found = met.unionByName(found.filter(F.size("lists") <= at))
    return found.select("k", "w", "n", "start")


def phrase_matches(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_id, k, phrase, n, start): every place of every window in the rows of ``docs``, compared word by word."""
    places = candidates(index).groupBy("k").agg(F.collect_set(F.struct("start", "n")).alias("places"))
    rows = docs.select("doc_id", row_key(docs).alias("k"), "text").join(places, "k")
    rows = rows.select("doc_id", "k", "places", words(F.col("text")).alias("ws"))
    phrases = F.transform(
        "places",
        lambda p: F.struct(
            p["start"].alias("start"), F.array_join(F.slice(F.col("ws"), p["start"] + 1, p["n"]), " ").alias("phrase")
        ),
    )
    each = rows.select("doc_id", "k", F.explode(phrases).alias("p")).select("doc_id", "k", "p.start", "p.phrase")
    return each.join(index.windows.select("phrase", "n"), "phrase")


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int, size: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, phrase): windows of ``items`` all of whose words occur in a row within ``slop`` words of their places.

    Places are counted from an occurrence of the window's rarest term. Candidates come
    from the stored lists; every word of them is then looked for in the row. Null texts
    and texts without words match nothing, on either side, nor do empty tables; rows
    that repeat a doc_id are judged one by one and told once. Texts may be of any
    length; other columns are not read.
    """
    index = build_index(docs, windows_of(items, size))
    near = candidates(index, slop).distinct().join(index.windows.select("w", "phrase"), "w")
    places = materialize(near.groupBy("k").agg(F.collect_set(F.struct("start", "phrase")).alias("places")), "near-places")
    rows = docs.select("doc_id", row_key(docs).alias("k"), "text").join(places, "k")
    rows = rows.select("doc_id", "places", words(F.col("text")).alias("ws"))

    def there(place, word, at):
        first = F.greatest(place["start"] + at - slop, F.lit(0)).cast("int")
        length = F.greatest(place["start"] + at + slop - first + 1, F.lit(0)).cast("int")
        return F.array_contains(F.slice(F.col("ws"), first + 1, length), word)

    def verified(place):
        told = F.transform(F.split(place["phrase"], " "), lambda word, at: there(place, word, at))
        return F.forall(told, lambda t: t)

    found = rows.select("doc_id", F.explode(F.filter("places", verified)).alias("p"))
    return found.select("doc_id", "p.phrase").distinct()


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """For each row of ``docs``: words, words hit, items found, digest of their ids, contaminated or not.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are not
    read. Null texts have no words. Rows that repeat a doc_id are judged one by one.
    Items without id hit words, but are not counted or listed.
    """
    windows = materialize(windows_of(items, size), "item-windows")
    matches = materialize(phrase_matches(docs, build_index(docs, windows)), "matches")
    places = F.transform(F.collect_set(F.struct("start", "n")), lambda p: F.sequence(p["start"], p["start"] + p["n"] - 1))
    hits = matches.groupBy("doc_id", "k").agg(F.size(F.array_distinct(F.flatten(places))).alias("n_hit"))
    # Items by row: matched windows of a row are few and distinct, whatever its length.
    named = matches.select("doc_id", "k", "phrase").distinct().join(windows.select("phrase", "item_id"), "phrase")
    found = named.groupBy("doc_id", "k").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    both = hits.join(found, hits["doc_id"].eqNullSafe(found["doc_id"]) & (hits["k"] == found["k"]), "left")
    both = both.select(hits["doc_id"].alias("h_doc"), hits["k"].alias("h_k"), "n_hit", "ids")
    rows = docs.select("doc_id", row_key(docs).alias("k"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    joined = rows.join(both, rows["doc_id"].eqNullSafe(both["h_doc"]) & (rows["k"] == both["h_k"]), "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` without any window of ``items``, with all their columns."""
    windows = materialize(windows_of(items, size), "item-windows")
    matches = phrase_matches(docs, build_index(docs, windows))
    leaks = materialize(matches.select(F.col("doc_id").alias("leak_doc"), F.col("k").alias("leak_key")).distinct(), "leaks")
    same = docs["doc_id"].eqNullSafe(leaks["leak_doc"]) & (row_key(docs) == leaks["leak_key"])
    return docs.join(leaks, same, "left_anti")
