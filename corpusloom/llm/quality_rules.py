"""Quality rules on documents: word statistics and cross-document line frequency.

Column functions and joins only. A line that stands in many documents of one host is
boilerplate; it is removed, and a document that consists of little else is rejected.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import broadcast_if_bounded
from ..plans.skew import HOT_ROWS, hot_keys
from .common import SPACE, WORD, free_names, work_table

SYMBOLS = "[#*$%&|<>]"

#: Base rules: fewest words, and largest share (percent) of words in repeated windows.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A line is boilerplate in a host if it stands in at least this many of the host's
#: different documents and in more than this share of them (percent).
LINE_DOCUMENTS = 20
LINE_PERCENT = 1
#: A document is depleted if boilerplate lines hold more than this share of its words.
MAX_REMOVED_PERCENT = 80

RULE_COLUMNS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "n_removed_lines",
    "removed_words",
    "clean_text",
    "kept",
)
#: Stands for the document itself among its line hashes.
_DOCUMENT = 0


def line_hash(line: Column) -> Column:
    """Hash of a line in lower case, runs of digits as one zero, without outer space."""
    plain = F.regexp_replace(F.lower(line), "[0-9]+", "0")
    return F.xxhash64(F.regexp_replace(plain, f"^{SPACE}+|{SPACE}+$", ""))


def _worded(lines: Column) -> Column:
    return F.filter(lines, lambda line: line.rlike(WORD))


def _repeated_places(
    docs: DataFrame, words: str, places: str, room: str, keys: str
) -> DataFrame:
    """Adds ``places``: sorted starts of three-word windows that occur twice or more.

    A window's hash (below 2**62 / words) and its start make one number, so that
    windows are sorted and compared as plain longs inside the row.
    """
    n = F.col("n_words")
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(3)])
    starts = F.sequence(F.lit(0), (n - 3).cast("int"))
    numbers = F.transform(starts, lambda i: F.pmod(window(i), F.col(room)) * n + i)
    none = F.array().cast("array<bigint>")
    docs = docs.withColumn(room, F.expr("4611686018427387904L div greatest(n_words, 1L)"))
    docs = docs.withColumn(keys, F.sort_array(F.when(n >= 4, numbers).otherwise(none)))
    same = F.expr(
        f"filter({keys}, (k, j) -> k div n_words = get({keys}, j - 1) div n_words"
        f" or k div n_words = get({keys}, j + 1) div n_words)"
    )
    docs = docs.withColumn(places, F.sort_array(F.transform(same, lambda k: k % n)))
    return docs.drop(room, keys)


def base_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with word statistics and ``base_failed``; a null text has no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, worded, places, room, keys = free_names(docs, 5)
    docs = (
        # Each step is a projection of its own, so that no array is made twice.
        docs.withColumn(words, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
        .withColumn("n_words", F.size(words).cast("long"))
        .withColumn(worded, _worded(F.split(text, "\n")))
    )
    docs = _repeated_places(docs, words, places, room, keys)
    covered = F.expr(
        f"aggregate(transform({places}, (p, j) ->"
        f" least(3L, coalesce(get({places}, j + 1), p + 3) - p)), 0L, (a, b) -> a + b)"
    )
    repeats = F.size(worded) - F.size(F.array_distinct(worded))
    too_repetitive = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    return (
        docs.withColumn("word_chars", F.length(F.array_join(words, "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_dup_lines", repeats.cast("long"))
        .withColumn("n_repeat_words", covered)
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | too_repetitive)
        .drop(words, worded, places)
    )


def frequent_lines(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    min_documents: int = LINE_DOCUMENTS,
    min_percent: float = LINE_PERCENT,
) -> DataFrame:
    """``host`` and ``frequent``, the hashes of its boilerplate lines.

    Copies of a text count as one document, so that a page crawled often does not
    make boilerplate of its own lines. A host has at most its mean number of lines
    per document * 100 / ``min_percent`` of them. Lines are summed per task before
    the shuffle. A null host is a host of its own.
    """
    lines = F.transform(_worded(F.split(text_col, "\n")), line_hash)
    hashes = F.array_distinct(F.concat(F.array(F.lit(_DOCUMENT).cast("long")), lines))
    counts = (
        docs.where(F.col(text_col).isNotNull())
        .select(
            F.col(host_col).alias("host"),
            F.xxhash64(text_col).alias("document"),
            F.explode(hashes).alias("line"),
        )
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_documents)
    )
    counts = work_table(counts)
    totals = counts.where(F.col("line") == _DOCUMENT).select(
        F.col("host").alias("of_host"), F.col("n").alias("total")
    )
    return (
        counts.where(F.col("line") != _DOCUMENT)
        .join(totals, F.col("host").eqNullSafe(F.col("of_host")))
        .where(F.col("n") * 100 > F.col("total") * min_percent)
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("line")).alias("frequent"))
    )


def _with_frequent(
    docs: DataFrame, hosts: DataFrame, host_col: str, frequent: str, hot_rows: int
) -> DataFrame:
    """``docs`` with the boilerplate lines of their host, null where it has none.

    If ``hosts`` is not small, the rows of a hot host are dealt to several tasks.
    """
    taken = docs.withColumn(frequent, F.lit(None))
    host, frequent_host, splits, salt, of_salt = free_names(taken, 5)
    hosts = hosts.select(F.col("host").alias(frequent_host), F.col("frequent").alias(frequent))
    small, bounded = broadcast_if_bounded(hosts)
    same_host = F.col(host_col).eqNullSafe(F.col(frequent_host))
    if bounded:
        return docs.join(small, same_host, "left").drop(frequent_host)
    counts = docs.groupBy(F.col(host_col).alias(host)).agg(F.count(F.lit(1)).alias(salt))
    hot = work_table(hot_keys(counts, [host], salt, hot_rows))
    hot = F.broadcast(hot.withColumnRenamed("_splits", splits))
    hashed = [F.col(name) for name, kind in docs.dtypes if "map<" not in kind]
    n_splits = F.coalesce(splits, F.lit(1))
    dealt = docs.join(hot, F.col(host_col).eqNullSafe(F.col(host)), "left")
    dealt = dealt.withColumn(salt, F.pmod(F.xxhash64(*hashed), n_splits).cast("int"))
    repeated = hosts.join(hot, F.col(frequent_host).eqNullSafe(F.col(host)), "left").select(
        frequent_host, frequent, F.explode(F.sequence(F.lit(0), n_splits - 1)).alias(of_salt)
    )
    return dealt.join(repeated, same_host & (F.col(salt) == F.col(of_salt)), "left").drop(
        host, splits, salt, of_salt, frequent_host
    )


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    max_removed_percent: float = MAX_REMOVED_PERCENT,
    min_documents: int = LINE_DOCUMENTS,
    min_percent: float = LINE_PERCENT,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``docs`` with the statistics, ``clean_text`` and the verdict ``kept``.

    ``clean_text`` is the text without its host's boilerplate lines (null stays
    null). A document is kept if the base rules pass and boilerplate does not hold
    more than ``max_removed_percent`` of its words. All rows come back, repeated ones
    too; columns that have the names of the new ones are replaced, all others stay as
    they are. The list of boilerplate lines is broadcast if its measured size allows;
    otherwise it is joined by host, hosts of more than ``hot_rows`` rows in parts.
    """
    hosts = work_table(frequent_lines(docs, text_col, host_col, min_documents, min_percent))
    replaced = {*RULE_COLUMNS} - {text_col.lower(), host_col.lower()}
    docs = docs.drop(*[name for name in docs.columns if name.lower() in replaced])
    (frequent,) = free_names(docs, 1)
    joined = _with_frequent(docs, hosts, host_col, frequent, hot_rows)
    # The host's lines that the document has: a few, whatever the host's number.
    hashes = F.transform(_worded(F.split(text_col, "\n")), line_hash)
    here = F.when(F.col(frequent).isNotNull(), F.array_intersect(hashes, F.col(frequent)))
    joined = joined.withColumn(frequent, here)
    (removed,) = free_names(joined, 1)
    boilerplate = lambda line: F.array_contains(frequent, line_hash(line))
    lines = F.split(text_col, "\n")
    taken = F.when(F.size(frequent) > 0, F.filter(_worded(lines), boilerplate))
    words = F.aggregate(
        removed,
        F.lit(0).cast("long"),
        lambda total, line: total + F.regexp_count(line, F.lit(WORD)),
    )
    keep = lambda line: ~line.rlike(WORD) | ~boilerplate(line)
    rest = F.array_join(F.filter(lines, keep), "\n")
    depleted = F.col("removed_words") * 100 > F.col("n_words") * max_removed_percent
    none = F.array().cast("array<string>")
    found = (
        base_statistics(joined.withColumn(removed, F.coalesce(taken, none)), text_col)
        .withColumn("n_removed_lines", F.size(removed).cast("long"))
        .withColumn("removed_words", words)
        .withColumn(
            "clean_text",
            F.when(F.col("n_removed_lines") > 0, rest).otherwise(F.col(text_col)),
        )
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )
    # Exploding one struct keeps the optimizer from putting the expressions of these
    # columns in the place of every reference to them, as it does for a filter.
    own = [F.col(name) for name in docs.columns if name.lower() not in RULE_COLUMNS]
    made = F.explode(F.array(F.struct(*RULE_COLUMNS)))
    (rules,) = free_names(docs, 1)
    return found.select(*own, made.alias(rules)).select(*own, f"{rules}.*")
