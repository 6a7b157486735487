"""Text columns: trimming, page splitting, tokens, highlights."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from folioline.fixed import PAGE_BREAK

# The 25 code points with the Unicode property White_Space.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# The same as a pattern: plain \\s is ASCII only.
BLANK = r"(?U:\s)"
NOT_BLANK = r"(?U:\S)"


def trim_space(col: Column) -> Column:
    """Strip Unicode white space on both ends (``trim`` alone strips blanks only)."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def to_int(col: Column) -> Column:
    """Whole number or NULL. Unlike ``try_cast``, surrounding blanks are not accepted."""
    return F.when(col.rlike(r"^[+-]?[0-9]+\z"), col.try_cast("long"))


def split_pages(text: Column) -> Column:
    """Array of the parts between form feeds; empty parts are kept."""
    return F.split(text, PAGE_BREAK)


def drop_empty_pages(parts: Column) -> Column:
    """Parts with at least one character. A part of white space only is kept."""
    return F.filter(parts, lambda part: F.length(part) > 0)


def tokens(text: Column) -> Column:
    """Maximal runs of non-blank characters, as they stand."""
    return F.array_remove(F.split(text, f"{BLANK}+"), "")


# The rules of the S stemmer, tried in this order, the first that matches applies: "ies" not after "a" or "e"
# becomes "y"; "es" not after "a", "e" or "o" becomes "e"; "s" not after "u" or "s" goes. Lower case only; the ending needs a letter
# before it, so no stem is empty.
S_RULES = [(r"([^ae])ies$", "y"), (r"([^aeo])es$", "e"), (r"([^us])s$", "")]


def s_stem(word: Column) -> Column:
    """The stem of a token by ``S_RULES``, in the JVM; NULL stays NULL."""
    out = word
    for pattern, ending in reversed(S_RULES):
        out = F.when(word.rlike(pattern), F.regexp_replace(word, pattern, f"$1{ending}")).otherwise(out)
    return out


def highlight(text: Column, terms: Iterable[str], before: str = "<b>", after: str = "</b>") -> Column:
    """Mark each token that is one of ``terms``; all other text stays untouched."""
    choice = "|".join(re.escape(term) for term in sorted(set(terms), key=lambda t: (-len(t), t)))
    if not choice:
        return text
    quote = lambda s: s.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(
        text, f"(?<!{NOT_BLANK})({choice})(?!{NOT_BLANK})", f"{quote(before)}$1{quote(after)}"
    )
