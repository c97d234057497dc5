"""The English analyzer in SQL, to check against: words, and the stem of each."""

from ..functions.stemming import STEP_2, STEP_3, STEP_4, STOP_WORDS

_STOPPED = ", ".join(f"'{word}'" for word in STOP_WORDS)


def english_words(text: str) -> str:
    """A list of the words that are stemmed."""
    found = f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+(?:[''’]s\\b)?')"
    bare = f"[regexp_replace(w, '[''’]s$', '') FOR w IN {found}]"
    return f"[w FOR w IN {bare} IF w NOT IN ({_STOPPED})]"


def _shape(word: str) -> str:
    """V and C for vowels and consonants; a y is what the letter before it is not."""
    shape = f"regexp_replace(regexp_replace({word}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g')"
    shape = f"regexp_replace({shape}, '^y', 'C')"
    for _ in range(3):
        shape = f"regexp_replace(regexp_replace({shape}, 'Cy', 'CV', 'g'), 'Vy', 'VC', 'g')"
    return shape


def _measure(word: str) -> str:
    return f"len(regexp_extract_all({_shape(word)}, 'V+C'))"


def _short(word: str) -> str:
    return f"({_shape(word)} LIKE '%CVC' AND right({word}, 1) NOT IN ('w', 'x', 'y'))"


def _without(count: int | str) -> str:
    return f"left(w, length(w) - {count})"


def _suffix(suffixes) -> str:
    """The longest of ``suffixes`` that ``w`` ends in, or null."""
    longest = sorted(suffixes, key=len, reverse=True)
    return "CASE " + " ".join(f"WHEN suffix(w, '{s}') THEN '{s}'" for s in longest) + " END"


def _replaced(table: dict[str, str]) -> str:
    return "CASE suf " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


def stems(words: str) -> str:
    """CTEs that end in ``stems(word, stem)`` for the column ``word`` of a relation."""
    cut = _without("length(suf)")
    doubled = "(length(s) > 1 AND right(s, 1) = left(right(s, 2), 1) AND right(shape, 1) = 'C')"
    return f"""
    step_1a AS (
        SELECT word, CASE WHEN suffix(word, 'sses') OR suffix(word, 'ies') THEN left(word, length(word) - 2)
            WHEN suffix(word, 's') AND NOT suffix(word, 'ss') THEN left(word, length(word) - 1)
            ELSE word END AS w FROM {words}
    ), step_1b AS (
        SELECT word, CASE WHEN suffix(w, 'eed') THEN
                CASE WHEN {_measure(_without(3))} > 0 THEN {_without(1)} ELSE w END
            WHEN NOT contains(coalesce(shape, ''), 'V') THEN w
            WHEN suffix(s, 'at') OR suffix(s, 'bl') OR suffix(s, 'iz') THEN s || 'e'
            WHEN {doubled} AND right(s, 1) NOT IN ('l', 's', 'z') THEN left(s, length(s) - 1)
            WHEN {_measure('s')} = 1 AND {_short('s')} THEN s || 'e'
            ELSE s END AS w
        FROM (SELECT *, {_shape('s')} AS shape FROM (
            SELECT *, CASE WHEN suffix(w, 'ed') THEN {_without(2)}
                WHEN suffix(w, 'ing') THEN {_without(3)} END AS s FROM step_1a))
    ), step_1c AS (
        SELECT word, CASE WHEN suffix(w, 'y') AND contains({_shape(_without(1))}, 'V')
            THEN {_without(1)} || 'i' ELSE w END AS w FROM step_1b
    ), step_2 AS (
        SELECT word, CASE WHEN suf IS NOT NULL AND {_measure(cut)} > 0
            THEN {cut} || {_replaced(STEP_2)} ELSE w END AS w
        FROM (SELECT *, {_suffix(STEP_2)} AS suf FROM step_1c)
    ), step_3 AS (
        SELECT word, CASE WHEN suf IS NOT NULL AND {_measure(cut)} > 0
            THEN {cut} || {_replaced(STEP_3)} ELSE w END AS w
        FROM (SELECT *, {_suffix(STEP_3)} AS suf FROM step_2)
    ), step_4 AS (
        SELECT word, CASE WHEN suf IS NOT NULL AND {_measure(cut)} > 1
                AND (suf <> 'ion' OR right({cut}, 1) IN ('s', 't'))
            THEN {cut} ELSE w END AS w
        FROM (SELECT *, {_suffix(STEP_4)} AS suf FROM step_3)
    ), step_5a AS (
        SELECT word, CASE WHEN suffix(w, 'e') AND ({_measure(_without(1))} > 1
                OR {_measure(_without(1))} = 1 AND NOT {_short(_without(1))})
            THEN {_without(1)} ELSE w END AS w FROM step_4
    ), stems AS (
        SELECT word, CASE WHEN length(word) <= 2 THEN word
            WHEN suffix(w, 'll') AND {_measure('w')} > 1 THEN {_without(1)} ELSE w END AS stem
        FROM step_5a
    )"""
