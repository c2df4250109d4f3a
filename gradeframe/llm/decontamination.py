"""Finding benchmark passages in training texts through a positional inverted index.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import column, pairs, small, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A word is a run of ASCII letters and digits and anything beyond ASCII.
WORD = r"[a-z0-9A-Z\x{80}-\x{10FFFF}]++"

DOC = ["key", "print"]


def words(text: Column) -> Column:
    """ARRAY<STRING>: the words of a text as they are written."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def lowered(written: Column) -> Column:
    """Words with A-Z lowered and no other letter changed, which is what counts as equal."""
    return F.transform(written, lambda w: F.translate(w, _UPPER, _LOWER))


def term(word: Column) -> Column:
    """What a word is indexed by: lowered by Unicode's rules, which is cheaper on whole
    texts. Equal words have equal terms; what has equal terms is checked for equal words."""
    return F.lower(word)


def _whole(df: DataFrame, text: str) -> Column:
    return F.coalesce(column(df, text).cast("string"), F.lit(""))


def _documents(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, print, text). Rows with equal key and text are the same document."""
    return pairs(df, key, text).select("key", F.xxhash64("text").alias("print"), "text")


@dataclass
class Phrases:
    """What is searched for: ``windows`` (window, words), and ``owners`` (window, item)."""

    windows: DataFrame
    owners: DataFrame
    length: int


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", length: int = 10) -> Phrases:
    """All runs of ``length`` words of the items; a shorter item is one window.

    Equal windows are searched once, whichever items they come from. Items without words
    (NULL, empty) have no window.
    """
    listed = pairs(benchmark, item, text).select("key", lowered(words(F.col("text"))).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(length - 1), F.lit(1)))
    runs = listed.select("key", F.explode(F.transform(starts, lambda i: F.slice("w", i, length))).alias("words"))
    runs = stored(runs.withColumn("phrase", F.array_join("words", " ")).distinct(), "item-windows")
    windows = runs.groupBy("phrase").agg(F.first("words").alias("words"))
    windows = stored(windows.withColumn("window", F.monotonically_increasing_id()), "windows")
    owners = runs.join(windows.select("phrase", "window"), "phrase").select("window", F.col("key").alias("item"))
    return Phrases(windows.select("window", "words"), stored(owners.distinct(), "owners"), length)


def rarest_terms(documents: DataFrame, phrases: Phrases, lists: int = 2) -> DataFrame:
    """Rows (window, rank, term, offset): where the search for a window starts.

    These are its ``lists`` rarest terms over all training texts, ties by term and offset.
    A window with a term that no text has cannot occur and is left out; one of a single
    word has it twice.
    """
    listed = phrases.windows.select("window", F.size("words").alias("length"), F.posexplode("words").alias("offset", "word"))
    places = listed.select("window", "length", "offset", term(F.col("word")).alias("term"))
    terms = small(places.select("term").distinct(), "terms")
    written = documents.select(F.explode(words(F.col("text"))).alias("word"))
    said = written.select(term(F.col("word")).alias("term")).join(terms, "term", "left_semi")
    counts = stored(said.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    ranked = (
        places.join(counts, "term")
        .groupBy("window", "length")
        .agg(F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("t"))
        .filter(F.size("t") == F.col("length"))
        .select("window", F.posexplode(F.slice(F.concat("t", "t"), 1, lists)).alias("rank", "t"))
    )
    return stored(ranked.select("window", "rank", "t.term", "t.offset"), "rarest")


def build_index(documents: DataFrame, rarest: DataFrame, length: int, slop: int = 0) -> DataFrame:
    """The stored index: a posting (term, key, print, position) for every place of a term.

    It holds the terms that searches start from. A posting of a window's rarest term also
    has its surroundings, ``length - 1`` words either way from word ``left`` on (and
    ``slop`` more), which a match is checked against without going back to the text.
    """
    terms = rarest.groupBy("term").agg((F.min("rank") == 0).alias("leads"))
    said = documents.select(*DOC, words(F.col("text")).alias("w")).select(*DOC, "w", F.posexplode("w").alias("position", "word"))
    left = F.greatest(F.col("position") - F.lit(length - 1 + slop), F.lit(0))
    around = F.slice("w", left + 1, 2 * (length + slop) - 1)
    postings = said.select(term(F.col("word")).alias("term"), *DOC, "position", left.alias("left"), around.alias("around"))
    found = postings.join(small(terms, "index-terms"), "term")
    return stored(
        found.select("term", *DOC, "position", "left", F.when(F.col("leads"), lowered(F.col("around"))).alias("around")),
        "postings",
    )


def matches(index: DataFrame, rarest: DataFrame, phrases: Phrases, slop: int = 0, lists: int = 2) -> DataFrame:
    """Rows (window, length, key, print, start, distance, exact), one for each match.

    Each posting, less the offset of its term, says where its window would start. The list
    of the rarest term is intersected with those of the next ones. ``exact`` matches have
    the very words of the window. With ``slop`` (the index must be built with it), every
    other word of the window may stand up to that many words off its place, and
    ``distance`` is the largest such shift: proximity matches. A word that is missing that
    near is no match. Places are those that the rarest term gives.
    """
    placed = index.join(small(rarest, "searches"), "term").withColumn("start", F.col("position") - F.col("offset"))
    # Rows for a window are needed once for every lead posting, and are at most ``length`` words.
    sought = small(phrases.windows, "sought")
    leads = placed.filter("rank = 0").join(sought, "window")
    here = F.slice("around", F.greatest(F.col("start") - F.col("left") + 1, F.lit(1)), F.size("words"))
    exact = (F.col("start") >= F.col("left")) & (here == F.col("words"))
    spot = ["window", *DOC, "start"]
    distance = _distance(slop) if slop else F.lit(0)
    found = leads.select(*spot, F.size("words").alias("length"), exact.alias("exact"), distance.alias("distance"))
    if slop:
        found = found.filter(F.col("distance").isNotNull())
    for rank in range(1, lists):
        near = F.sequence(F.col("start") - F.lit(slop), F.col("start") + F.lit(slop)) if slop else F.array("start")
        other = placed.filter(F.col("rank") == rank).select(
            F.col("window").alias("w"), F.col("key").alias("__k"), F.col("print").alias("__p"), F.explode(near).alias("s"), F.col("start").alias("own")
        )
        same = (
            (F.col("window") == F.col("w"))
            & F.col("key").eqNullSafe(F.col("__k"))
            & (F.col("print") == F.col("__p"))
            & (F.col("start") == F.col("s"))
        )
        shift = F.greatest("distance", F.abs(F.col("own") - F.col("s")))
        joined = found.join(other, same).select(*spot, "length", "exact", shift.alias("distance"))
        found = joined.groupBy(*spot, "length").agg(F.max("exact").alias("exact"), F.min("distance").alias("distance"))
    return found


def _distance(slop: int) -> Column:
    """How far the words of a window are off their places at most, each at its nearest
    occurrence; NULL if one is more than ``slop`` words off."""

    def shift(i: Column) -> Column:
        here = F.col("start") - F.col("left") + i
        hits = F.filter(
            F.sequence(F.lit(-slop), F.lit(slop)),
            lambda d: F.coalesce(F.get("around", here + d) == F.get("words", i), F.lit(False)),
        )
        return F.array_min(F.transform(hits, F.abs))

    shifts = F.transform(F.sequence(F.lit(0), F.size("words") - 1), shift)
    return F.when(~F.exists(shifts, lambda s: s.isNull()), F.array_max(shifts))


def _exact_matches(
    docs: DataFrame, benchmark: DataFrame, item: str, item_text: str, length: int
) -> tuple[DataFrame, Phrases]:
    phrases = item_windows(benchmark, item, item_text, length)
    rarest = rarest_terms(docs, phrases)
    index = build_index(docs, rarest, length)
    found = matches(index, rarest, phrases).filter("exact").select("window", *DOC, "start", "length")
    return stored(found, "matches"), phrases


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on key and print, NULL keys included; the columns of ``right`` beyond them come along."""
    other = right.withColumnRenamed("key", "__k").withColumnRenamed("print", "__p")
    same = F.col("key").eqNullSafe(F.col("__k")) & (F.col("print") == F.col("__p"))
    return left.join(other, same, how).drop("__k", "__p")


def uncontaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    length: int = 10,
) -> DataFrame:
    """The documents in which no benchmark window occurs, with all their columns."""
    found, _ = _exact_matches(_documents(documents, key, text), benchmark, item, item_text, length)
    hit = small(found.select(*DOC).distinct(), "hit")
    hit = hit.withColumnsRenamed({"key": "__k", "print": "__p"})
    keyed = documents.select("*", column(documents, key).alias("__key"), F.xxhash64(_whole(documents, text)).alias("__print"))
    same = F.col("__key").eqNullSafe(F.col("__k")) & (F.col("__print") == F.col("__p"))
    return keyed.join(hit, same, "left_anti").drop("__key", "__print")


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    length: int = 10,
) -> DataFrame:
    """Rows (key, n_words, n_hit, items): one for each document, repeated rows included.

    A word is hit if it lies in an occurrence of a benchmark window; ``items`` is the
    sorted array of the ids, as text, of the items whose windows occur. An item with a NULL
    id hits words but is not listed. NULL and empty texts have no words, an empty benchmark
    hits nothing.

    The texts are read three times (count terms, write postings, count words) and never
    shuffled. What is shuffled are matches.
    """
    docs = _documents(documents, key, text)
    found, phrases = _exact_matches(docs, benchmark, item, item_text, length)
    before = Window.partitionBy(*DOC).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    # Words of a match that no earlier match has covered.
    fresh = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    hits = found.withColumn("fresh", fresh).groupBy(*DOC).agg(F.sum("fresh").alias("n_hit"))
    owned = found.select("window", *DOC).distinct().join(small(phrases.owners, "owned"), "window")
    items = owned.groupBy(*DOC).agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))

    counted = docs.select(*DOC, F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("n_words"))
    none = F.array().cast("array<string>")

    return _joined(_joined(counted, hits, "left"), items, "left").select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    )
