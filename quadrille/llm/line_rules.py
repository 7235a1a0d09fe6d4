"""Quality rules: counts inside a text, and how many documents of its host share its lines. DataFrame functions alone.

A line is what stands between ``\\n``. Normalised, it has A-Z in lower case, its runs of ASCII white space are single blanks, and
none stand at its ends; lines without a word are not counted. The lines of a document are hashed, and per host (``source``) the
documents that hold a line are counted. A line is frequent, and removed, when more than ``least_documents`` documents of
the host and more than ``percent_documents`` percent of them hold it. A document is depleted, and rejected, when more than
``percent_removed`` percent of its words stand in removed lines.

Every row is a document of its own, so repeated rows count as often as they occur. Rows without a source are one host. Null
and empty texts have no words and fail the base rule, as does every text of fewer than ``LEAST_WORDS`` words. The order of rows and ties play no
part. Only the columns ``doc_id, source, text`` are read; others, whatever their names, are left out of verdicts and stay in
``without_frequent_lines``. A text is read whole; its words are one array of its task while its row is at work.

One scan writes a narrow row per document: counts, and hash and word count of every line. All else is done on those rows. Counts
per host and line are partial before the shuffle, so a hot host or line is one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm.tables import stored
from quadrille.plans.sizing import broadcast_if_small

#: Texts of fewer words fail the base rule, and so do texts with a larger share of words in repeated windows.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: A line is frequent in more documents of its host than this, and in a larger share of them.
LEAST_DOCUMENTS, PERCENT_DOCUMENTS = 5, 5
#: A document is depleted when a larger share of its words stands in frequent lines.
PERCENT_REMOVED = 50
#: Words of a window whose repetition is looked for.
WINDOW = 3

_WORD, _SPACE, _SYMBOL = "[^\\x20\\x09-\\x0D]+", "[\\x20\\x09-\\x0D]+", "[#*$%&|<>]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Low bits of a window's mark hold its place; a row cannot hold an array of so many words.
_PLACE_BITS = 28


def line_counts(docs: DataFrame) -> DataFrame:
    """``row, doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines``, a stored row per document.

    ``lines`` has the hash and the number of words of each line with a word; ``row`` is a number of the stored row.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("source").alias("host"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    lines = texts.select("*", F.filter(F.split("text", "\n"), lambda line: line.rlike(_WORD)).alias("raw"))
    parted = lines.select(
        "row", "doc_id", "host", F.transform("raw", _words).alias("by_line"),
        F.regexp_count("text", F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
    )
    counted = _repeated(parted.select("*", F.flatten("by_line").alias("words")), "words").select(
        "row", "doc_id", "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols", "n_dup_lines", "n_repeat_words",
        F.transform("by_line", lambda own: F.struct(_line_hash(own).alias("line"), F.size(own).alias("words"))).alias("lines"),
    )
    return stored(counted, "line-counts")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE), "")


def _line_hash(words: Column) -> Column:
    return F.xxhash64(F.translate(F.array_join(words, " "), _UPPER, _LOWER))


def _repeated(rows: DataFrame, words: str) -> DataFrame:
    """Adds ``n_repeat_words``: words in windows that the text holds more than once, by sorting inside the row.

    Windows are sorted by some bits of their hash; those with an equal neighbour are then sorted by their very words.
    """
    rest = [f"get({words}, _i + {k})" for k in range(1, WINDOW)]
    every = f"transform({words}, (_w, _i) -> shiftleft(xxhash64(_w, {', '.join(rest)}), {_PLACE_BITS}) | _i)"
    marks = f"sort_array(slice({every}, 1, greatest(0, size({words}) - {WINDOW - 1})))"
    bits = f"shiftright({{}}, {_PLACE_BITS})"
    near = " or ".join(f"{bits.format('_m')} = {bits.format(f'get(_marks, _k {way} 1)')}" for way in "-+")
    place = f"cast(_m & {(1 << _PLACE_BITS) - 1}L as int)"
    exact = f"array_join(slice({words}, {place} + 1, {WINDOW}), ' ')"
    maybe = f"sort_array(transform(filter(_marks, (_m, _k) -> {near}), _m -> struct({exact} as text, {place} as place)))"
    same = " or ".join(f"_w.text = get(_maybe, _k {way} 1).text" for way in "-+")
    places = f"sort_array(transform(filter(_maybe, (_w, _k) -> {same}), _w -> _w.place))"
    covered = f"aggregate(transform(_places, (_p, _k) -> least({WINDOW}, coalesce(get(_places, _k + 1) - _p, {WINDOW}))), 0L, (_a, _b) -> _a + _b)"
    step = rows
    for name, made in (("_marks", marks), ("_maybe", maybe), ("_places", places)):
        step = step.select("*", F.expr(made).alias(name))
    return step.select(*rows.columns, F.expr(covered).alias("n_repeat_words"))


def frequent_lines(counts: DataFrame, *, least_documents: int = LEAST_DOCUMENTS, percent_documents: int = PERCENT_DOCUMENTS) -> DataFrame:
    """``host, line, n``: the lines above both limits, and the number of the host's documents that hold them."""
    own = counts.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    shared = own.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least_documents)
    hosts = counts.groupBy(F.col("host").alias("_host")).agg(F.count(F.lit(1)).alias("_documents"))
    met = shared.join(broadcast_if_small(hosts), F.col("host").eqNullSafe(F.col("_host")))
    return met.where(F.col("n") * 100 > F.col("_documents") * percent_documents).select("host", "line", "n")


def _with_removed(counts: DataFrame, least_documents: int, percent_documents: int) -> DataFrame:
    """``counts`` with the words in removed lines, and those lines."""
    frequent = stored(frequent_lines(counts, least_documents=least_documents, percent_documents=percent_documents), "frequent-lines")
    side = broadcast_if_small(frequent.select(F.col("host").alias("_host"), F.col("line").alias("_line")))
    lines = counts.select("row", "host", F.inline("lines"))
    hits = lines.join(side, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
    # What one document holds of frequent lines: no more than its own lines.
    gone = hits.groupBy("row").agg(F.sum("words").alias("n_removed_words"), F.collect_set("line").alias("gone"))
    return counts.join(gone, "row", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))


def quality_rules(
    docs: DataFrame, *, least_documents: int = LEAST_DOCUMENTS, percent_documents: int = PERCENT_DOCUMENTS, percent_removed: int = PERCENT_REMOVED
) -> DataFrame:
    """A row per document: its counts, ``base_failed``, ``kept``, ``n_removed_words``."""
    judged = _with_removed(line_counts(docs), least_documents, percent_documents)
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)
    depleted = F.col("n_removed_words") * 100 > F.col("n_words") * percent_removed
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"), "n_removed_words",
    )


def without_frequent_lines(
    docs: DataFrame, *, least_documents: int = LEAST_DOCUMENTS, percent_documents: int = PERCENT_DOCUMENTS, percent_removed: int = PERCENT_REMOVED
) -> DataFrame:
    """The documents that are not depleted, all columns, their texts without the frequent lines; the base rule is not applied.

    Null texts stay null. Documents are stored once with a number of their own, by which the lines to remove come back.
    """
    number = "row"
    while number in docs.columns:
        number = f"_{number}"
    numbered = stored(docs.select("*", F.monotonically_increasing_id().alias(number)), "documents")
    counts = line_counts(numbered.select(F.col(number).alias("doc_id"), "source", "text"))
    judged = _with_removed(counts, least_documents, percent_documents)
    kept = judged.where(F.col("n_removed_words") * 100 <= F.col("n_words") * percent_removed)
    kept = kept.select(F.col("doc_id").alias("_number"), F.coalesce("gone", F.array().cast("array<long>")).alias("_gone"))
    met = numbered.join(kept, F.col(number) == F.col("_number"))
    left = F.filter(F.split("text", "\n"), lambda x: ~x.rlike(_WORD) | ~F.array_contains("_gone", _line_hash(_words(x))))
    cut = F.when(F.size("_gone") == 0, F.col("text")).otherwise(F.array_join(left, "\n"))
    return met.withColumn("text", cut).select(*docs.columns)
