"""Text column expressions. All of them run JVM-side; none is a Python function per value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python counts as white space (`\s`, `str.strip`), once as the body
# of a regex class and once as a plain string. Java's `\s` misses the non-ASCII ones.
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The letters kept before tokenising, and what counts as a vectoriser token.
KEPT = "a-zA-Zà-úÀ-Ú"
TOKEN_PATTERN = "[a-zà-öø-ú]{2,}"


def strip(c: Column) -> Column:
    """Remove white space at both ends, Unicode-wide."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def collapse_space(c: Column) -> Column:
    """Every run of white space becomes one blank.

    The look-ahead passes over printable ASCII and over a blank before it, which is most of a
    text, without trying the long class (about twice as fast).
    """
    return F.regexp_replace(c, f"(?![!-~]| [!-~])[{SPACE_CLASS}]+", " ")


def clean_text(c: Column) -> Column:
    """Line feeds and carriage returns become blanks (one each); ends are stripped."""
    return strip(F.translate(c, "\n\r", "  "))


def truncate_text(c: Column, n: int = 1000) -> Column:
    """First `n` characters plus `...` where the text is longer."""
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def list_to_string(c: Column, sep: str = "; ") -> Column:
    """Array to one string, null items skipped; a null array stays null."""
    return F.when(c.isNotNull(), F.concat_ws(sep, c.cast("array<string>")))


def variant_to_string(c: Column, sep: str = "; ") -> Column:
    """List-or-scalar variant to string: lists are joined, scalars pass through."""
    return F.when(
        F.schema_of_variant(c).startswith("ARRAY"),
        F.concat_ws(sep, F.try_variant_get(c, "$", "array<string>")),
    ).otherwise(F.try_variant_get(c, "$", "string"))


def html_to_text(c: Column) -> Column:
    """Drop comments and non-content blocks, then tags; collapse white space."""
    for block in ("<!--.*?-->", *(f"<{t}\\b.*?</{t}>" for t in ("script", "style", "nav", "footer"))):
        c = F.regexp_replace(c, f"(?is){block}", " ")
    return strip(collapse_space(F.regexp_replace(c, "(?s)<[^>]*>", " ")))


def sentence_line(c: Column) -> Column:
    """The text as one line of non-empty sentences glued with `'. '`, without the last dot.

    One pass: a run of white space and dots becomes its first dot, if any, and a blank. The
    look-ahead passes over printable ASCII other than dots, and over a blank before it.
    """
    skip = r"(?![!-\-/-~]| [!-\-/-~])"
    run = rf"{skip}(?=[{SPACE_CLASS}.])[{SPACE_CLASS}]*(\.?)[{SPACE_CLASS}.]*"
    return F.btrim(F.regexp_replace(c, run, "$1 "), F.lit(". "))


def paragraphs_of_line(line: Column, min_len: int = 300) -> Column:
    """Cut a sentence line into paragraphs: an array, in text order.

    A paragraph is the shortest run of whole sentences of at least `min_len` characters, closed
    by a dot; the rest at the end is a paragraph whatever its length. In a sentence line every dot
    ends a sentence, so the first dot at or after offset `min_len` is the place to cut, which makes
    the greedy fold one linear regex scan.
    """
    pattern = rf"(?s) ?(.{{{min_len}}}[^.]*\.|.+)"
    return F.when(
        line != "", F.regexp_extract_all(F.concat(line, F.lit(".")), F.lit(pattern), F.lit(1))
    ).when(line.isNotNull(), F.array().cast("array<string>"))


def contains_any(lowered: Column, terms: Sequence[str]) -> Column:
    """Whether an already lower-cased text contains any of the terms."""
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(lowered, F.lit(term.lower()))
    return found


def matched_terms(lowered: Column, terms: Sequence[str]) -> Column:
    """The terms an already lower-cased text contains, in list order."""
    return F.array_compact(
        F.array(*[F.when(F.contains(lowered, F.lit(t.lower())), F.lit(t)) for t in terms])
    )


def tokens(c: Column) -> Column:
    """Lower-case, delete all but letters and white space, split on white space.

    The look-ahead lets the frequent characters skip the long class (about six times faster).
    """
    kept = F.regexp_replace(F.lower(c), f"(?![a-z ])[^{KEPT}{SPACE_CLASS}]+", "")
    return F.array_remove(F.split(kept, f"(?![!-~])[{SPACE_CLASS}]+"), "")


def vectoriser_tokens(words: Column) -> Column:
    """Runs of at least two letters in the joined words, as a bag-of-words vectoriser reads them."""
    return F.regexp_extract_all(F.concat_ws(" ", words), F.lit(TOKEN_PATTERN), F.lit(0))


def ngrams(toks: Column) -> Column:
    """All single tokens followed by all pairs of neighbours."""
    pairs = F.zip_with(
        F.slice(toks, F.lit(1), F.greatest(F.size(toks) - 1, F.lit(0))),
        F.slice(toks, F.lit(2), F.greatest(F.size(toks) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(toks, pairs)
