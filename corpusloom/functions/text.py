"""Text clean-up and the word splitter that feeds WordPiece."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from corpusloom.functions.arrays import running_sum

# The characters stripped from both ends of a document or question.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The rule line of the books corpus, between two blank lines.
RULE_LINE = "\n\n" + "━" * 79 + "\n\n"

# Character classes of the standard BERT word splitter (valid in Java and RE2 syntax).
PUNCTUATION = r"!-/:-@\[-`{-~\p{P}"
CJK = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)
SPACE = r" \t\n\r\p{Z}"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F\x{FFFD}\p{Cf}\p{Co}]"
WORD = rf"[{PUNCTUATION}{CJK}]|[^{SPACE}{PUNCTUATION}{CJK}]+"
LEADING_SPACE = rf"^[{SPACE}]+"
SPACED_WORD = rf"[{SPACE}]*(?:{WORD})"


def strip(text: Column) -> Column:
    """Remove white space from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def document_text(text: Column) -> Column:
    """A pre-training document: stripped, then ended by one newline."""
    return F.concat(strip(text), F.lit("\n"))


def without_rule_lines(text: Column) -> Column:
    """Delete every literal rule line with its surrounding blank lines."""
    return F.replace(text, F.lit(RULE_LINE), F.lit(""))


def _accent_pairs() -> tuple[str, str]:
    plain = {}
    for code in range(0xC0, 0x10000):
        char = chr(code)
        decomposed = unicodedata.normalize("NFD", char)
        if len(decomposed) > 1 and all(unicodedata.category(c) == "Mn" for c in decomposed[1:]):
            plain[char] = decomposed[0]
    return "".join(plain), "".join(plain.values())


_ACCENTED, _PLAIN = _accent_pairs()


def strip_accents(text: Column) -> Column:
    """Base letters only: precomposed letters by rule, then free combining marks."""
    return F.regexp_replace(F.translate(text, _ACCENTED, _PLAIN), r"\p{Mn}", "")


def normalize_word(text: Column, accents: bool = False) -> Column:
    """Drop control characters, lower-case and (unless ``accents``) strip accents."""
    lowered = F.lower(F.regexp_replace(text, CONTROL, ""))
    return lowered if accents else strip_accents(lowered)


def words(text: Column, accents: bool = False) -> Column:
    """Normalised words and single punctuation marks in reading order."""
    return F.array_remove(F.split(words_apart(text, accents), f"[{SPACE}]+"), "")


def words_apart(text: Column, accents: bool = False) -> Column:
    """The same words as one text, with white space between them."""
    return F.regexp_replace(normalize_word(text, accents), f"[{PUNCTUATION}{CJK}]", " $0 ")


def word_spans(text: Column) -> Column:
    """``array<struct<raw, e>>``: white-space-led words of the original text with their end offsets.

    Each match keeps its leading white space, so the matches tile the text and the running sum of
    their lengths is the end offset of each word.
    """
    return F.transform(
        F.array(F.regexp_extract_all(text, F.lit(SPACED_WORD), F.lit(0))),
        lambda runs: F.arrays_zip(runs.alias("raw"), running_sum(F.transform(runs, F.length)).alias("e")),
    )[0]
