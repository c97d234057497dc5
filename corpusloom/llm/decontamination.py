"""Benchmark decontamination by canonical templates.

Numbers, names and units become typed placeholders. Windows of canonical tokens of
the documents are looked up among those of the benchmark; where a window agrees, the
tokens are compared and the slots must be filled consistently: the same benchmark
value always by the same document value, and different ones by different ones. That
finds questions whose parameters were changed, besides verbatim ones.

There are two canonical forms. In the strict one a capitalised word that opens a
sentence is a word; in the loose one it is a name unless it is a function word, as the
names of word problems often open sentences.
"""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import span_hashes, text_blocks, window_hashes, word_spans

#: Tokens in a window. A shorter item is one window, with its first token and without.
WINDOW = 13
#: Literal words, in percent, from which a window counts by itself. One with fewer counts
#: if the whole item stands there, filled consistently.
LITERAL_PERCENT = 50
#: Fewest tokens of an item that is found by windows of fewer literal words. They need one
#: literal that is no function word.
SLOT_ITEM = 4
#: Benchmark text that one pass over the documents looks for.
PASS_BYTES = 16 << 20
#: Words that count as units after a number. Fixed values.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles g kg mg lb lbs pound pounds "
    "oz ounce ounces ton tons l ml liter liters litre litres gallon gallons s sec second seconds "
    "min minute minutes h hr hour hours day days week weeks month months year years mph kmh "
    "dollar dollars cent cents euro euros percent degree degrees".split()
)

#: Words that are no names where they open a sentence. Fixed values.
FUNCTION_WORDS = frozenset(
    "a about after all also an and any are as at be because before both but by can could did do "
    "does during each either every few find finally first for from given had has have he her here "
    "his how however i if in into is it its last later let many more most my next no not now of on "
    "one or other our she should since so some such suppose than that the their then there these "
    "they this those though thus to two under until was we were what when where whether which while "
    "who whose why will with would you your".split()
)

LITERAL, NUMBER, NAME, UNIT = range(4)
#: Ways to look at tokens: as they are, strict and loose canonical form.
PLAIN, STRICT, LOOSE = range(3)
_MARKS = (b"<literal>", b"<number>", b"<name>", b"<unit>")
_NEWLINE = ord("\n")


def _byte_set(chars) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[ord(char) for char in chars]] = True
    return table


_SENTENCE_END = _byte_set(".!?:;|")
_DIGIT = _byte_set("0123456789")
_CAPITAL = _byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
# Second byte of the capitals from U+00C0 to U+00DE in UTF-8; the first is 0xC3.
_LATIN_CAPITAL = _byte_set(map(chr, range(0x80, 0x9F))) & ~_byte_set("\x97")
_PUNCTUATION = _byte_set([chr(c) for c in range(128) if not chr(c).isalnum()])


def _hashes_of(words: list[bytes]) -> np.ndarray:
    lengths = np.array([len(word) for word in words], dtype=np.int64)
    ends = np.cumsum(lengths)
    return span_hashes(np.frombuffer(b"".join(words), np.uint8), ends - lengths, ends)


_UNIT_HASHES = np.sort(_hashes_of([unit.encode() for unit in sorted(UNITS)]))
_FUNCTION_HASHES = np.sort(_hashes_of([word.encode() for word in sorted(FUNCTION_WORDS)]))
_MARK_HASHES = _hashes_of(list(_MARKS))


def _is_in(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return known[place] == hashes


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = [text.encode() for text in texts]
    offsets = np.concatenate(([0], np.cumsum([len(part) for part in parts]))).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), offsets


def _cores(data: np.ndarray, offsets: np.ndarray):
    """Words without outer punctuation, and the last byte of each before that."""
    starts, ends, _ = word_spans(data, offsets)
    solid = np.flatnonzero(~_PUNCTUATION[data])
    after = np.searchsorted(solid, starts)
    before = np.searchsorted(solid, ends) - 1
    real = after <= before
    return starts, ends, solid[after[real]], solid[before[real]] + 1, real


def _capital(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a capital stands at each place, and the place after the character."""
    second = data[np.minimum(at + 1, len(data) - 1)]
    wide = data[at] == 0xC3
    capital = _CAPITAL[data[at]] | (wide & _LATIN_CAPITAL[second])
    return capital, at + 1 + wide


class Tokens:
    """Words of some texts: lower-cased without outer punctuation, and their kinds.

    Words are separated by ASCII white space; those that are punctuation alone are
    left out. A number begins with a digit; a unit follows a number; a name is a
    capitalised word (not all capitals) after another word of the same sentence. In
    ``loose`` it is one anywhere, unless it is a function word.
    """

    def __init__(self, texts: list[str]):
        self.data, offsets = _joined([text.lower() for text in texts])
        _, _, self.starts, self.ends, _ = _cores(self.data, offsets)
        self.first = np.searchsorted(self.starts, offsets)
        self.literal = span_hashes(self.data, self.starts, self.ends)
        n = len(self.starts)
        self.kinds = np.zeros(n, dtype=np.int8)
        self.loose = np.zeros(n, dtype=np.int8)
        self.function = _is_in(self.literal, _FUNCTION_HASHES)
        if n:
            self._find_kinds(*_joined(texts))

    def kinds_in(self, form: int) -> np.ndarray:
        return self.loose if form == LOOSE else self.kinds

    def codes(self, form: int) -> np.ndarray:
        """Hashes of the tokens or, in a canonical form, of the marks of slots."""
        if form == PLAIN:
            return self.literal
        kinds = self.kinds_in(form)
        return np.where(kinds != LITERAL, _MARK_HASHES[kinds], self.literal)

    def _find_kinds(self, raw: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, core, core_end, real = _cores(raw, offsets)
        number = _DIGIT[raw[core]]
        unit = _is_in(self.literal, _UNIT_HASHES)
        opens = np.zeros(len(core) + 1, dtype=bool)
        opens[self.first] = True  # first word of its text
        unit[1:] &= number[:-1] & ~opens[1:-1]
        unit[:1] = False
        # A word is inside a sentence if the one before, on its line, does not end one.
        lines = np.cumsum(raw == _NEWLINE)[starts]
        inside = np.zeros(len(starts), dtype=bool)
        inside[1:] = (lines[1:] == lines[:-1]) & ~_SENTENCE_END[raw[ends[:-1] - 1]]
        text_of = np.searchsorted(offsets, starts, side="right")
        inside[1:] &= text_of[1:] == text_of[:-1]
        capital, after = _capital(raw, core)
        again, _ = _capital(raw, np.minimum(after, len(raw) - 1))
        capitalised = capital & ~(again & (after < core_end))
        names = capitalised & inside[real], capitalised & ~self.function
        for kinds, name in zip((self.kinds, self.loose), names):
            kinds[name] = NAME
            kinds[number] = NUMBER
            kinds[unit & ~number] = UNIT

    def word(self, at: int) -> bytes:
        return self.data[self.starts[at] : self.ends[at]].tobytes()


class TemplateIndex:
    """Windows of benchmark items by the hash of their tokens, in every form.

    Plain windows are kept beside the canonical ones, for copies whose letters
    changed case.
    """

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        self.keys = [key for key, _ in items]
        self.tokens = Tokens([text for _, text in items])
        found = defaultdict(set)
        for number in range(len(items)):
            first, end = self.tokens.first[number : number + 2]
            n = int(end - first)
            spans = [(i, window) for i in range(n - window + 1)]
            if n <= window:
                spans = [(0, n), (1, n - 1)] if n > 1 else [(0, n)] if n else []
            for start, width in spans:
                part = slice(first + start, first + start + width)
                for form, code in self._codes(part, n):
                    found[width].add((code, number, start, form))
        self.by_width = {}
        for width, rows in found.items():
            rows = sorted(rows)
            codes = np.array([row[0] for row in rows], np.uint64)
            seen = np.zeros(1 << 22, dtype=bool)
            seen[codes >> np.uint64(42)] = True
            self.by_width[width] = (codes, seen, [row[1:] for row in rows])

    def _codes(self, part: slice, n: int) -> Iterator[tuple[int, int]]:
        """Forms in which a window of an item of ``n`` tokens is looked up, and its codes."""
        width = part.stop - part.start
        plain = int(window_hashes(self.tokens.literal[part], width)[0])
        yield PLAIN, plain
        for form in (STRICT, LOOSE):
            literal = self.tokens.kinds_in(form)[part] == LITERAL
            telling = n >= SLOT_ITEM and bool((literal & ~self.tokens.function[part]).any())
            if telling or not self._is_slotted(literal):
                code = int(window_hashes(self.tokens.codes(form)[part], width)[0])
                if code != plain:
                    yield form, code

    @staticmethod
    def _is_slotted(literal: np.ndarray) -> bool:
        return 100 * int(literal.sum()) < LITERAL_PERCENT * len(literal)

    def candidates(self, hashes: np.ndarray, first: np.ndarray, form: int):
        """(document, place in it, item, place in it, width) of equal window hashes."""
        for width, (codes, seen, rows) in self.by_width.items():
            windows = window_hashes(hashes, width)
            places = np.flatnonzero(seen[windows >> np.uint64(42)])
            low = np.searchsorted(codes, windows[places], "left")
            high = np.searchsorted(codes, windows[places], "right")
            hit = np.flatnonzero(high > low)
            docs = np.searchsorted(first, places[hit], side="right") - 1
            for at, doc, a, b in zip(places[hit], docs, low[hit], high[hit]):
                if at + width <= first[doc + 1]:
                    for number, start, of_form in rows[a:b]:
                        if of_form == form:
                            yield int(doc), int(at - first[doc]), number, start, width

    def verdict(
        self, tokens: Tokens, doc: int, number: int, shift: int, form: int, spans
    ) -> tuple[set, set]:
        """Exact and template windows of one alignment of an item with a document.

        ``shift`` is the place in the document minus that in the item. If the slots
        of the alignment are not filled consistently, only exact windows count. Windows
        of mostly slots count if the whole item agrees.
        """
        mine, own = tokens.first[doc] + shift, self.tokens.first[number]
        my_kinds, kinds = tokens.kinds_in(form), self.tokens.kinds_in(form)
        exact, same, slotted = set(), set(), set()
        fills: dict[bytes, bytes] = {}
        backs: dict[bytes, bytes] = {}
        consistent = True

        def compare(start: int, width: int) -> tuple[bool, bool]:
            nonlocal consistent
            equal = alike = True
            for k in range(start, start + width):
                word, asked = tokens.word(mine + k), self.tokens.word(own + k)
                slot = kinds[own + k] != LITERAL
                if word != asked:
                    equal = False
                    alike &= bool(slot and my_kinds[mine + k] == kinds[own + k])
                if slot:
                    consistent &= fills.setdefault(asked, word) == word
                    consistent &= backs.setdefault(word, asked) == asked
            return equal, alike

        for start, width in spans:
            equal, alike = compare(start, width)
            literal = kinds[own + start : own + start + width] == LITERAL
            chosen = exact if equal else slotted if self._is_slotted(literal) else same
            if alike:
                chosen.add((shift, start, width))
        if slotted and consistent:
            n = self.tokens.first[number + 1] - own
            inside = shift >= 0 and mine + n <= tokens.first[doc + 1]
            if inside and compare(0, n)[1] and consistent:
                same |= slotted
            else:
                # What lies outside the windows speaks against the slotted ones only.
                consistent = True
        return exact, same if consistent else set()


def find_leaks(texts: list[str], index: TemplateIndex) -> Iterator[tuple[int, int, str, int]]:
    """(text number, item key, kind, windows) of texts that hold windows of items."""
    tokens = Tokens(texts)
    alignments = defaultdict(set)
    for form in (PLAIN, STRICT, LOOSE):
        hits = index.candidates(tokens.codes(form), tokens.first, form)
        for doc, at, number, start, width in hits:
            # Plain windows are slots filled by themselves, for the strict form.
            key = doc, number, at - start, max(form, STRICT)
            alignments[key].add((start, width))
    found = defaultdict(lambda: (set(), set()))
    for (doc, number, shift, form), spans in alignments.items():
        verdict = index.verdict(tokens, doc, number, shift, form, sorted(spans))
        for windows, new in zip(found[doc, number], verdict):
            windows |= new
    for (doc, number), (exact, same) in sorted(found.items()):
        if exact or same:
            yield doc, index.keys[number], "exact" if exact else "template", len(exact | same)


LEAK_SCHEMA = "doc_id long, item_id long, kind string, n_windows long"


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Pairs of documents and the benchmark items they hold, one row per pair.

    ``kind`` is ``exact`` if a window stands there word for word. Null or empty texts
    and items match nothing; rows with a null id come back with it; repeated rows
    count once. The benchmark is looked up in passes of about ``pass_bytes``, each a
    bounded broadcast and a scan of the documents without a shuffle; the pairs found
    are few and are merged by a shuffle.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")
    ).where(F.length("text") > 0)
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-size // pass_bytes))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = spark.createDataFrame([], LEAK_SCHEMA)
    for number in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number)
        index = TemplateIndex([(row["item_id"], row["text"]) for row in part.collect()])
        shipped = spark.sparkContext.broadcast(index)

        def look(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, _, offsets in text_blocks(batch, "text"):
                    n = len(offsets) - 1
                    ids = batch.column("id").slice(row, n).to_pylist()
                    block = [text or "" for text in batch.column("text").slice(row, n).to_pylist()]
                    rows = [
                        (ids[doc], item, kind, count)
                        for doc, item, kind, count in find_leaks(block, shipped.value)
                    ]
                    if rows:
                        names = ["doc_id", "item_id", "kind", "n_windows"]
                        arrays = [pa.array(values) for values in zip(*rows)]
                        yield pa.RecordBatch.from_arrays(arrays, names=names)

        found = found.union(texts.mapInArrow(look, LEAK_SCHEMA))
    return found.groupBy("doc_id", "item_id").agg(
        F.min("kind").alias("kind"), F.max("n_windows").alias("n_windows")
    )
