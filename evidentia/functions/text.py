"""Text normalisers as column expressions.

Whitespace and line ends are written out as explicit classes: the JVM's ``\\s``
is ASCII only, and readings carry no-break and other Unicode spaces.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_HORIZONTAL = r"\t\x1f\x20\xa0\u1680\u2000-\u200a\u202f\u205f\u3000"
_VERTICAL = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
#: White space below the blank, by kind: two within a line, six that end one.
_CONTROLS = "\t\x1f\r\x0b\x0c\x1c\x1d\x1e"
#: Other white space than ASCII has.
_BEYOND = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = f"[{_HORIZONTAL}{_VERTICAL}]"
LINE_BREAK = rf"\r\n|[{_VERTICAL}]"
EDGE = " .,:;"

# All that does not stay in a folded key; spelled out, as the JVM takes several times as long for a negated class.
_OTHER = r"[\x00-\x2f\x3a-\x60\x7b-\x{10ffff}]+"

# Letters that a pattern of any case and script takes for an ASCII letter, beside its two cases.
_ALIKE = {"i": "İı", "k": "\u212a", "s": "ſ"}

# Letters whose full case folding is not their lower case.
_FOLD = {"ſ": "s", "ς": "σ", "ß": "ss", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}


def casefold(c: Column) -> Column:
    """Full case folding of the letters that occur in print.

    Chained byte replacements: each is a search that leaves a text without the
    letter untouched, where a character map would rebuild every text. A text
    of as many bytes as characters is ASCII and holds none of them.
    """
    folded = F.lower(c)
    for letter, expansion in _FOLD.items():
        folded = F.replace(folded, F.lit(letter), F.lit(expansion))
    return F.when(is_ascii(c), F.lower(c)).otherwise(folded)


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def word(first: str, pattern: str) -> str:
    """``pattern``, of any case, at the start of a word; ``first`` holds the letters it may start with.

    Looking for those first spares most places the test for a word's start,
    which is slow for all scripts.
    """
    letters = "".join(f"{x.upper()}{x.lower()}{_ALIKE.get(x.lower(), '')}" for x in first)
    return rf"(?=[{letters}])(?iU)\b{pattern}"


def normalize_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"{SPACE}+", " "))


def anchor_text(c: Column) -> Column:
    """Folded text with every run of other characters reduced to one space."""
    return F.trim(F.regexp_replace(casefold(c), _OTHER, " "))


def category_key(c: Column) -> Column:
    return F.regexp_replace(casefold(c), _OTHER, "")


def mask_digits(c: Column) -> Column:
    """The text form the n-gram models are trained on."""
    masked = F.regexp_replace(casefold(c), r"(?U)\d", "#")
    # as normalize_space, but blanks that stay are not written anew: there is one behind every word
    blank = F.when(c.rlike(f"[{_BEYOND}]"), F.regexp_replace(masked, f"[\n{_CONTROLS}{_BEYOND}]", " ")).otherwise(F.regexp_replace(masked, f"[\n{_CONTROLS}]", " "))
    return F.trim(F.regexp_replace(F.coalesce(blank, F.lit("")), " {2,}", " "))


def excerpt(c: Column, length: int = 160) -> Column:
    return F.substring(normalize_space(c), 1, length)


def rows_text(c: Column) -> Column:
    """Non-empty lines, each space-normalised, joined by a newline.

    Kept as one string rather than an array so that the label readers stay
    inside whole-stage code generation.
    """
    lines = F.regexp_replace(c, LINE_BREAK, "\n")
    lines = F.regexp_replace(lines, f"[{_HORIZONTAL}]+", " ")
    # most texts are ASCII without control characters: only runs of spaces are left to shorten
    plain = F.when(c.rlike(f"[{_CONTROLS}]"), F.translate(c, _CONTROLS, "  \n\n\n\n\n\n")).otherwise(c)
    plain = F.regexp_replace(plain, " {2,}", " ")
    return F.btrim(F.regexp_replace(F.when(is_ascii(c), plain).otherwise(lines), r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def rows(c: Column) -> Column:
    return F.filter(F.split(rows_text(c), "\n"), lambda line: line != "")


def raw_lines(c: Column) -> Column:
    """Lines as they stand, for the readers that inspect unnormalised lines."""
    return F.split(c, LINE_BREAK)


def label_next_row(rows_col: Column, label: str) -> Column:
    """The row under the first row that consists of the label alone; '' if none."""
    return F.regexp_extract(rows_col, rf"(?im)^{label} ?:?\n([^\n]+)", 1)


def label_inline(text: Column, label: str) -> Column:
    """What follows the label on its own line, up to 90 characters or a break."""
    starts = re.match(r"(?:\(\?:([A-Za-z])[\w ]*\)\?)?([A-Za-z])", label)  # a letter, or that of an optional word before it
    pattern = rf"{label}[ \t]*:?[ \t]*([^|;\n]{{1,90}})"
    found = F.regexp_extract(text, word("".join(filter(None, starts.groups())), pattern) if starts else rf"(?iU)\b{pattern}", 1)
    return F.btrim(normalize_space(found), F.lit(EDGE))


def extract_label(text: Column, rows_col: Column, label: str) -> Column:
    """Label on its own row first, else inline.

    ``label`` is a pattern. A matched own-row label wins even when its value
    is punctuation only, in which case the result is ''.
    """
    below = F.nullif(label_next_row(rows_col, label), F.lit(""))
    return F.coalesce(F.btrim(below, F.lit(EDGE)), label_inline(text, label))


def value_before_label(row_array: Column, label: str, validator, reach: int = 4) -> Column:
    """First accepted value among the rows above a label row, nearest first."""
    is_label = F.transform(row_array, lambda r: F.regexp_like(r, F.lit(rf"(?i)\A{label} ?:?\z")))
    above = F.transform(
        F.filter(
            F.transform(is_label, lambda hit, i: F.when(hit, i)),
            lambda i: i.isNotNull() & (i > 0),
        ),
        lambda i: F.reverse(
            F.slice(row_array, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)))
        ),
    )
    accepted = F.filter(F.transform(F.flatten(above), validator), lambda v: v != "")
    return F.coalesce(F.try_element_at(accepted, F.lit(1)), F.lit(""))


def first_nonempty(*values: Column) -> Column:
    """The first value that is neither NULL nor ''; later ones are not evaluated."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))
