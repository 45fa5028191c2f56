"""Text expressions: tokens, front matter, sections, word windows, sentences.

Whitespace and digits follow Unicode rules (``(?U)``): Java's plain ``\\s`` and Spark's
``trim`` know only ASCII and would leave a no-break space in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chunk window in words and the words shared by neighbouring windows.
WINDOW_WORDS = 130
OVERLAP_WORDS = 30

# Fixed patterns.
TOKEN = "[a-z0-9]+"
FRONT_MATTER = r"(?sU)\A---\s*\n(.*?)\n---\s*\n"
HEADING = r"(?mdU)^(#{1,6})\s+(.*)$"
SENTENCE_BREAK = r"(?U)(?<=[.!?])\s+(?=[-*A-Z0-9])"
LIST_PREFIX = r"(?U)^\s*[-*]\s+"
BOLD = r"\*\*(.+?)\*\*"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def strip_column(text: Column) -> Column:
    """``strip`` of a column that is at hand: only a text with whitespace at an end is searched.

    The text is named several times, so anything that is computed belongs in ``strip``.
    """
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return F.when(ends.rlike(r"(?U)\s"), strip(text)).otherwise(text)


def collapse(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def tokens(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def words(text: Column) -> Column:
    """Whitespace-separated words; none for blank text."""
    return F.filter(F.split(text, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")


def front_matter(raw: Column) -> Column:
    """The text between the leading ``---`` lines, null where there is none."""
    return F.when(raw.rlike(FRONT_MATTER), F.regexp_extract(raw, FRONT_MATTER, 1))


def front_matter_value(block: Column, key: str) -> Column:
    """Value of ``key`` in a front-matter block: the last line that sets it, else null."""
    lines = F.filter(
        F.split(block, "\n"),
        lambda line: line.contains(":") & (strip(F.substring_index(line, ":", 1)) == key),
    )
    last = F.try_element_at(lines, F.lit(-1))
    return strip(F.regexp_replace(last, r"(?s)\A[^:]*:", ""))


def without_front_matter(raw: Column) -> Column:
    return F.regexp_replace(raw, FRONT_MATTER, "")


def sections(body: Column, keep_preamble: bool = False) -> Column:
    """``array<struct<heading, text>>`` of a Markdown body, in document order.

    A heading without text yields nothing; text before the first heading is dropped unless
    ``keep_preamble``; a body without any heading is one section with an empty heading.
    """

    def pair(heading: Column, text: Column) -> Column:
        return F.struct(strip(heading).alias("heading"), strip(text).alias("text"))

    headings = F.regexp_extract_all(body, F.lit(HEADING), F.lit(2))
    pieces = F.split(body, HEADING)
    names = F.concat(F.array(F.lit("")), headings) if keep_preamble else headings
    texts = pieces if keep_preamble else F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1)))
    found = F.filter(F.zip_with(names, texts, pair), lambda s: s["text"] != "")
    whole = F.array(pair(F.lit(""), body))
    return F.when(F.size(headings) == 0, whole).otherwise(found)


def word_windows(
    text: Column, window: int = WINDOW_WORDS, overlap: int = OVERLAP_WORDS
) -> Column:
    """Overlapping word windows of ``text``; short text is a single window.

    Windows start every ``window - overlap`` words; the last is the first that reaches the
    end of the text.
    """
    step = window - overlap

    def cut(w: Column) -> Column:
        later = F.ceil((F.size(w) - window) / F.lit(step)).cast("int")
        starts = F.sequence(F.lit(0), F.greatest(later, F.lit(0)) * step, F.lit(step))
        return F.transform(
            starts, lambda s: F.array_join(F.slice(w, s + 1, F.lit(window)), " ")
        )

    return let(words(text), cut)


def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` where a capital, digit or bullet follows."""
    return F.split(text, SENTENCE_BREAK)


def clean_sentence(sentence: Column) -> Column:
    """Without list prefix and bold marks, whitespace collapsed."""
    return collapse(F.regexp_replace(F.regexp_replace(sentence, LIST_PREFIX, ""), BOLD, "$1"))


def word_count(text: Column) -> Column:
    return F.size(words(text))
