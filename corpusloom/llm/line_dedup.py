"""Fuzzy line deduplication by MinHash, with column functions and joins only.

A line is the set of its shingles of ``SHINGLE_CHARS`` characters, one from every
character on; a shorter line is one shingle. Each shingle gets one hash, which also deals it
to one of ``BINS`` bins; the signature holds the smallest hash of each bin, which is MinHash
with one permutation. Only hashes small enough for ``PER_BIN`` of a line's shingles per bin
take part, so that a long line costs little after hashing; a bin without one is empty and
agrees with an empty bin.

A band is ``BAND_BINS`` successive bins. Lines that agree in a band meet; each is compared
with the smallest of its bucket by the exact Jaccard similarity of the whole sets. Linked
lines form components, of which the first line in the corpus stays. Two lines of
similarity J agree in a band with a probability of about J ** 3: with eight bands in some
band with 0.987 at J = 0.75 and 0.9999 at J = 0.9.

Lines that meet in a bucket which another line leads are compared too, all of them, unless
they are of one component by then or cannot link: two sets that do have sizes of one order and
differ in few shingles, which their sketches bound from below. ``HUBS`` lines of each bucket are
compared first with all others of it, so that pairs inside a large group of near copies are not
made; then the nearest left of each line, the rest after that.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import broadcast_if_bounded, hot_keys, salted_join
from .common import SPACE, WORD, free_names, release, work_table
from .components import connected_components

SHINGLE_CHARS = 12
#: Bins of a signature, and successive bins in a band.
BINS = 24
BAND_BINS = 3
BANDS = [list(range(k, k + BAND_BINS)) for k in range(0, BINS, BAND_BINS)]
#: Shingles per bin that a long line has below its bound on hashes, on average: a bin is left
#: empty by the bound with a probability of exp(-8).
PER_BIN = 8
#: Words of 64 bits in the sketch of a line's shingles; a power of two.
SKETCH_WORDS = 16
#: Lines of each bucket that all others of it are compared with first.
HUBS = 4
#: Lines of a large bucket that are compared with those of another block in one cell.
BLOCK_LINES = 4096
#: Tasks per core among which few lines are dealt.
SPREAD = 4
#: Jaccard similarity from which lines link, in percent.
PERCENT = 75
#: Buckets and lines that are sent to all tasks rather than shuffled for.
MAX_BUCKETS = 1_000_000
#: Size up to which the places of candidate lines are broadcast to the scan.
MAX_WANTED_BYTES = 128 << 20

_NULL_ID = -(2**63)
#: Bytes of a character as the shingles are cut from it.
_WIDE = 4
_MINS = [f"m{k}" for k in range(BINS)]
_WORDS = [f"w{k}" for k in range(SKETCH_WORDS)]
#: What tells a document from others, and a line.
_DOC = ["doc", "version"]
_PLACE = [*_DOC, "place"]


def normal_line(line: Column) -> Column:
    """A line in lower case with single spaces between its words."""
    return _single_spaced(F.trim(F.lower(line)))


def _single_spaced(plain: Column) -> Column:
    # Few lines hold other white space; for the rest a search for it is all.
    odd = F.contains(plain, F.lit("  "))
    for control in "\t\x0b\x0c\r":
        odd |= F.contains(plain, F.lit(control))
    return F.when(odd, F.trim(F.regexp_replace(plain, f"{SPACE}+", " "))).otherwise(plain)


def _wide_starts(wide: Column) -> Column:
    """The places, in bytes, of the shingles in a line of UTF-32."""
    last = F.octet_length(wide) - (_WIDE * SHINGLE_CHARS - 1)
    return F.sequence(F.lit(1), F.greatest(last, F.lit(1)), F.lit(_WIDE))


def _shingle(wide: Column, start: Column) -> Column:
    """The bytes of the shingle at ``start``.

    Characters of one width are cut at their bytes, so that a long line takes time in
    proportion to its length.
    """
    return F.substring(wide, start, F.lit(_WIDE * SHINGLE_CHARS))


def shingles(line: Column) -> Column:
    """Hashes of the character shingles of a normal line."""

    def of_line(wide: Column) -> Column:
        return F.transform(_wide_starts(wide), lambda start: F.xxhash64(_shingle(wide, start)))

    # A lambda holds the wide characters, so that they are made once.
    wide = F.array(F.encode(line, "UTF-32"))
    return F.get(F.transform(wide, of_line), F.lit(0))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc"),
        F.xxhash64(text_col).alias("version"),
        F.col(text_col).alias("text"),
    )


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc``, ``version``, ``place``, ``chars``, ``line`` of each line with a word."""
    texts = _texts(docs, id_col, text_col).select(
        *_DOC, F.posexplode(F.split("text", "\n")).alias("place", "raw")
    )
    plain = F.trim(F.lower("raw"))
    return (
        texts.where(F.col("raw").rlike(WORD))
        .select(*_PLACE, F.length("raw").alias("chars"), plain.alias("plain"))
        .select(*_PLACE, "chars", _single_spaced(F.col("plain")).alias("line"))
    )


def with_signatures(lines: DataFrame) -> DataFrame:
    """``hash`` of each line and its signature, a column per bin.

    Shingles are rows of one task, hashed and summed up there; what is shuffled is a
    row per line.
    """
    rest = [name for name in lines.columns if name != "line"]
    cut = lines.select(
        *rest, F.xxhash64("line").alias("hash"), F.encode("line", "UTF-32").alias("wide")
    )
    rows = cut.select(
        *rest,
        "hash",
        F.greatest(F.octet_length("wide") / _WIDE - (SHINGLE_CHARS - 1), F.lit(1.0)).alias("n"),
        "wide",
        F.explode(_wide_starts(F.col("wide"))).alias("start"),
    )
    value = F.shiftrightunsigned(F.hash(_shingle(F.col("wide"), F.col("start"))), 1)
    small = rows.select(*rest, "hash", "n", value.alias("value")).where(
        F.col("value") * F.col("n") < float(PER_BIN * BINS * 2**31)
    )
    dealt = small.select(*rest, "hash", "value", (F.col("value") % BINS).alias("bin"))
    least = [F.min(F.when(F.col("bin") == k, F.col("value"))).alias(_MINS[k]) for k in range(BINS)]
    return dealt.groupBy(*rest, "hash").agg(*least)


def _keys_of_bands(bands: list[list[int]]) -> list[Column]:
    """A key for each band of bins, null for one whose bins are empty."""
    keys = []
    for number, bins in enumerate(bands):
        names = [_MINS[k] for k in bins]
        filled = F.coalesce(*names).isNotNull()
        values = [F.coalesce(F.col(name), F.lit(-1)) for name in names]
        keys.append(F.when(filled, F.xxhash64(F.lit(number), *values)))
    return keys


def _met(found: DataFrame) -> DataFrame:
    """``key``, ``a``, ``hash``: each line with the smallest of each of its buckets."""
    keys = found.select("hash", F.explode(F.array(*_keys_of_bands(BANDS))).alias("key"))
    keys = keys.where("key is not null")
    # A bucket of any size is one row here, summed up in each task before the shuffle.
    buckets = work_table(
        keys.groupBy("key")
        .agg(F.min("hash").alias("a"), F.max("hash").alias("top"), F.count(F.lit(1)).alias("n"))
        .where("a != top")
    )
    met = _in_buckets(keys, buckets, ["key", "a"])
    return met.where("hash != a").distinct()


def _in_buckets(keys: DataFrame, buckets: DataFrame, columns: list[str]) -> DataFrame:
    """``keys`` joined with ``columns`` of their buckets, of ``n`` rows each.

    Few buckets are sent to the keys; else the keys of large ones are salted.
    """
    small, fits = broadcast_if_bounded(buckets.select(*columns), max_rows=MAX_BUCKETS)
    if fits:
        return keys.join(small, "key")
    hot = hot_keys(buckets.groupBy("key").agg(F.max("n").alias("n")), ["key"], "n")
    return salted_join(keys, buckets.select(*columns), ["key"], ["hash"], hot)


def _with_root(rows: DataFrame, roots: DataFrame, name: str, of: str) -> DataFrame:
    """``rows`` with ``of``, the component of the line in ``name``: itself, if alone."""
    side, _ = broadcast_if_bounded(roots.select(F.col("node").alias(name), F.col("root").alias(of)))
    return rows.join(side, name, "left").withColumn(of, F.coalesce(of, name))


def _sketches(lines: DataFrame) -> DataFrame:
    """``hash``, ``size`` of the shingle set and its sketch, a column per word.

    A bit of the sketch is the parity of the shingles that fall on it, so that two sets
    differ in at least as many shingles as their sketches do in bits.
    """
    rows = lines.select("hash", F.explode(F.array_distinct(shingles(F.col("line")))).alias("s"))
    word = F.col("s").bitwiseAND(F.lit(SKETCH_WORDS - 1))
    place = F.shiftright("s", SKETCH_WORDS.bit_length() - 1).bitwiseAND(F.lit(63)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    rows = rows.select("hash", word.alias("word"), bit.alias("bit"))
    words = [
        F.coalesce(F.bit_xor(F.when(F.col("word") == k, F.col("bit"))), F.lit(0)).alias(name)
        for k, name in enumerate(_WORDS)
    ]
    return rows.groupBy("hash").agg(F.count(F.lit(1)).alias("size"), *words)


def _met_again(met: DataFrame, roots: DataFrame, found: DataFrame, lines: DataFrame):
    """Lines of buckets that hold several components: their ``keys``, one per band, with
    sizes and sketches, and ``hash``, ``band``, ``key`` of each of their buckets.

    Taken are lines that met in such a bucket without leading it.
    """
    met = _with_root(met.select("key", "hash"), roots, "hash", "root")
    several, _ = broadcast_if_bounded(work_table(_several(met).select("key")), MAX_BUCKETS)
    ids, _ = broadcast_if_bounded(work_table(met.join(several, "key").select("hash").distinct()))
    least = [F.min(name).alias(name) for name in _MINS]
    bins = found.join(ids, "hash", "left_semi").groupBy("hash").agg(*least)
    keyed = bins.select("hash", F.array(*_keys_of_bands(BANDS)).alias("keys"))
    sketches = _sketches(lines.join(ids, "hash", "left_semi"))
    of_line = work_table(keyed.join(sketches, "hash"))
    rows = of_line.select("hash", F.posexplode("keys").alias("band", "key"))
    return of_line, rows.where("key is not null")


def _several(rows: DataFrame) -> DataFrame:
    """``key`` and ``n``, the number of ``rows``, of the buckets with more than one root."""
    ends = F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")
    return rows.groupBy("key").agg(*ends).where("low != high").select("key", "n")


def _far(x: str, y: str) -> Column:
    """The number of bits in which the sketches of two lines differ."""
    words = [F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))) for w in _WORDS]
    return sum(words, F.lit(0))


def _near(x: str, y: str) -> Column:
    """Whether two lines may link by their sizes and sketches."""
    smaller = F.least(f"{x}.size", f"{y}.size")
    larger = F.greatest(f"{x}.size", f"{y}.size")
    return (smaller * 100 >= larger * PERCENT) & (
        _far(x, y) * (100 + PERCENT) <= (smaller + larger) * (100 - PERCENT)
    )


def _with_hubs(rows: DataFrame, of_line: DataFrame, roots: DataFrame) -> DataFrame:
    """``a`` < ``b``: each line with ``HUBS`` lines of each of its buckets, those of other
    components that may link by their sizes and sketches."""
    rows = work_table(_with_root(rows, roots, "hash", "root"))
    turns = [F.max(F.struct(F.xxhash64("hash", F.lit(k)), "hash", "root")) for k in range(HUBS)]
    hubs = rows.groupBy("key").agg(F.array(*turns).alias("hubs"), F.count(F.lit(1)).alias("n"))
    hubs = work_table(_several(rows).select("key").join(hubs, "key"))
    met = _in_buckets(rows, hubs, ["key", "hubs"])
    met = met.select("hash", "root", F.explode("hubs").alias("hub")).where("root != hub.root")
    ends = F.least("hash", "hub.hash").alias("a"), F.greatest("hash", "hub.hash").alias("b")
    pairs = met.select(*ends).distinct()
    for name, end in ("x", "a"), ("y", "b"):
        side = of_line.select(F.col("hash").alias(end), F.struct("size", *_WORDS).alias(name))
        pairs = pairs.join(side, end)
    return work_table(pairs.where(_near("x", "y")).select("a", "b"))


def _rest(rows: DataFrame, of_line: DataFrame, roots: DataFrame) -> DataFrame:
    """``a`` < ``b`` and ``far``: lines of different components that may link by their sizes
    and sketches, of all pairs that share a bucket.

    A pair is made in the first bucket it shares. Few lines are sent to all tasks; of more,
    large buckets are dealt in blocks, of which every two meet in a cell of their own.
    """
    rows = work_table(_with_root(rows, roots, "hash", "root"))
    full = work_table(_several(rows))
    last = (F.ceil(F.col("n") / BLOCK_LINES) - 1).cast("int")
    rows = _in_buckets(rows, full, ["key", "n"]).select("*", last.alias("last")).drop("n")
    own = F.pmod("hash", F.col("last") + 1).cast("int")
    rows = work_table(rows.withColumn("own", own).join(of_line, "hash"))
    small, fits = broadcast_if_bounded(rows)
    if fits:
        # Each task takes some lines of all buckets.
        tasks = SPREAD * rows.sparkSession.sparkContext.defaultParallelism
        x, y = rows.repartition(tasks, "hash").alias("x"), small.alias("y")
        meet = (F.col("x.key") == F.col("y.key")) & (F.col("x.hash") < F.col("y.hash"))
    else:
        cells = (
            rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
            .withColumn("i", F.least("own", "other"))
            .withColumn("j", F.greatest("own", "other"))
            .drop("last", "other")
        )
        x, y = cells.alias("x"), cells.alias("y")
        inside = (F.col("x.i") == F.col("x.j")) & (F.col("x.hash") < F.col("y.hash"))
        meet = (
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.i") == F.col("y.i"))
            & (F.col("x.j") == F.col("y.j"))
            & ((F.col("x.own") < F.col("y.own")) | inside)
        )
    agree = F.zip_with("x.keys", "y.keys", lambda one, other: one == other)
    first = F.array_position(agree, True) - 1
    other = F.col("x.root") != F.col("y.root")
    pairs = x.join(y, meet & other & _near("x", "y") & (first == F.col("x.band"))).select(
        F.least("x.hash", "y.hash").alias("a"),
        F.greatest("x.hash", "y.hash").alias("b"),
        _far("x", "y").alias("far"),
    )
    pairs = work_table(pairs)
    release(full, rows)
    return pairs


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Those ``pairs`` whose lines are of different components."""
    both = _with_root(_with_root(pairs, roots, "a", "of_a"), roots, "b", "of_b")
    return both.where("of_a != of_b")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after ``links`` more."""
    if links.isEmpty():
        return roots
    # Components are nodes now: only those that the new links join change.
    of_links = _apart(links, roots).select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    merged = connected_components(of_links).select(
        F.col("node").alias("root"), F.col("root").alias("into")
    )
    nodes = roots.select("node").union(links.select(F.explode(F.array("a", "b")))).distinct()
    known = _with_root(nodes, roots, "node", "root").join(merged, "root", "left")
    return work_table(known.select("node", F.coalesce("into", "root").alias("root")))


def _components(found: DataFrame, texts: DataFrame) -> DataFrame:
    """``node`` and ``root`` of lines that link."""
    met = work_table(_met(found))
    pairs = work_table(met.select("a", F.col("hash").alias("b")).distinct())
    lines = work_table(_lines_of_pairs(texts, found, pairs))
    roots = work_table(connected_components(work_table(_linked(lines, pairs))))
    of_line, rows = _met_again(met, roots, found, lines)
    # Most lines that link are of one component after their hubs.
    hubs = _with_hubs(rows, of_line, roots)
    roots = _joined(roots, work_table(_linked(lines, hubs)))
    rest = _rest(rows, of_line, roots)
    # The nearest of each line first: most others are of one component then.
    turned = rest.union(rest.select(F.col("b").alias("a"), F.col("a").alias("b"), "far"))
    nearest = turned.groupBy("a").agg(F.min(F.struct("far", "b")).alias("to"))
    nearest = nearest.select(F.least("a", "to.b").alias("a"), F.greatest("a", "to.b").alias("b"))
    roots = _joined(roots, work_table(_linked(lines, work_table(nearest.distinct()))))
    others = work_table(_apart(rest, roots).select("a", "b"))
    return _joined(roots, work_table(_linked(lines, others)))


def _lines_of_pairs(texts: DataFrame, found: DataFrame, pairs: DataFrame) -> DataFrame:
    """``hash`` and ``line`` of the lines in ``pairs``, each read at its first place."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("hash")).distinct()
    ids, _ = broadcast_if_bounded(work_table(ids))
    first = found.join(ids, "hash").groupBy("hash").agg(F.min(F.struct(*_PLACE)).alias("at"))
    wanted = work_table(
        first.groupBy(*[F.col(f"at.{name}").alias(name) for name in _DOC]).agg(
            F.collect_list(F.struct("at.place", "hash")).alias("wanted")
        )
    )
    small, _ = broadcast_if_bounded(wanted, max_bytes=MAX_WANTED_BYTES)
    asked = (
        texts.join(small, _DOC)
        .select(F.split("text", "\n").alias("lines"), F.explode("wanted").alias("w"))
        .select("w.hash", normal_line(F.get("lines", F.col("w.place"))).alias("line"))
    )
    return asked.groupBy("hash").agg(F.min("line").alias("line"))


def _linked(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those pairs whose whole shingle sets are similar enough.

    ``lines`` has the ``hash`` and ``line`` of all of them.
    """
    both = pairs.select("a", "b")
    for name in "ab":
        side = lines.select(F.col("hash").alias(name), F.col("line").alias(f"line_{name}"))
        both = both.join(side, name)
    # An exploded row of one element holds what is made once and used more than once.
    sets = F.struct(shingles(F.col("line_a")).alias("left"), shingles(F.col("line_b")).alias("right"))
    sets = both.select("a", "b", F.explode(F.array(sets)).alias("s"))
    shared = F.size(F.array_intersect("s.left", "s.right"))
    union = F.size(F.array_union("s.left", "s.right"))
    return sets.where(shared * 100 >= union * PERCENT).select("a", "b")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_removed_lines``, ``removed_chars``, ``clean_text``.

    Of each component of equal or similar lines, the one with the smallest id and
    place stays. All lines with a word are judged, those shorter than a shingle by being
    equal. Documents keep their rows, even if no line is left; a null text stays null with
    no lines. Ids are whole numbers; a null id comes before all others. Rows of one id and
    text are one document and keep the same lines; those of one id and other texts are
    documents of their own, in the order of a hash. Columns with the new names are replaced,
    other columns may have any name.
    """
    found = work_table(with_signatures(_lines(docs, id_col, text_col)))
    roots = _components(found, _texts(docs, id_col, text_col))
    # Lines that occur once and link with none are left out from here on.
    repeated = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    of_line = work_table(
        repeated.join(roots.withColumnRenamed("node", "hash"), "hash", "full").select(
            "hash", F.coalesce("root", "hash").alias("root"), F.coalesce("n", F.lit(1)).alias("n")
        )
    )
    lines = found.select(*_PLACE, "chars", "hash")
    small, fits = broadcast_if_bounded(of_line.drop("n"), max_rows=MAX_BUCKETS)
    if not fits:
        hot = hot_keys(of_line, ["hash"], "n")
        lines = salted_join(lines, of_line.drop("n"), ["hash"], _PLACE, hot)
    else:
        lines = lines.join(small, "hash")
    lines = work_table(lines)
    place = F.struct(*_PLACE)
    kept = work_table(lines.groupBy("root").agg(F.min(place).alias("keep"), F.count(F.lit(1)).alias("n")))
    hot = hot_keys(kept, ["root"], "n")
    removed = work_table(
        salted_join(lines, kept.drop("n"), ["root"], _PLACE, hot)
        .where(place != F.col("keep"))
        .groupBy(*_DOC)
        .agg(F.collect_set("place").alias("places"), F.sum("chars").alias("chars"))
    )
    by_doc, by_version, places, chars = free_names(docs, 4)
    removed, _ = broadcast_if_bounded(removed.toDF(by_doc, by_version, places, chars))
    of_row = (F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)) == F.col(by_doc)) & (
        F.xxhash64(text_col) == F.col(by_version)
    )
    split = F.split(text_col, "\n")
    rest = F.filter(split, lambda line, at: ~F.array_contains(places, at))
    text = F.when(F.col(places).isNull(), F.col(text_col)).otherwise(F.array_join(rest, "\n"))
    new = {
        "n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(F.size(split)),
        "n_removed_lines": F.coalesce(F.array_size(places), F.lit(0)),
        "removed_chars": F.coalesce(chars, F.lit(0)).cast("long"),
        "clean_text": text,
    }
    old = [F.col(name) for name in docs.columns if name not in new]
    return docs.join(removed, of_row, "left").select(
        *old, *(value.alias(name) for name, value in new.items())
    )
