"""Text and token arrays."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shrink(text: Column | str) -> Column:
    """Collapse runs of white space into one blank and trim."""
    return F.trim(F.regexp_replace(_col(text), r"\s+", " "))


def tokenise(text: Column | str, min_length: int = 1) -> Column:
    """Lower-case runs of letters with at least `min_length` letters.

    One regular expression does the splitting and the length rule, so no lambda runs per
    token; white space needs no collapsing first, as only letters are kept.
    """
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(rf"\p{{L}}{{{min_length},}}"), 0)


# Signs that hold a word together, and words that lose their end before a vowel.
JOINERS = "-'’.&/_"
ELIDED = ("c", "d", "j", "jusqu", "l", "m", "n", "qu", "s", "t")
# What is neither white space, nor letter, mark or digit.
_SYMBOL = r"[^\x09-\x0D\p{Z}\p{L}\p{M}\p{N}]"


def token_rules(
    exceptions: Iterable[str] = (), joiners: str = JOINERS, elided: Iterable[str] = ELIDED
) -> str:
    """The rules of `rule_tokenise` as one regular expression, without look-around.

    In the order in which they are tried: `exceptions`, strings that are a token as they stand
    and end in a symbol; capitals with a full stop each, at least two; a word of `elided` with
    its apostrophe; letters, marks and digits, with one of `joiners` at a time between them;
    any other symbol by itself. The same text works in every engine with Unicode classes.
    """
    listed = sorted(set(exceptions), key=lambda x: (-len(x), x))
    if wrong := [x for x in listed if not x or x[-1].isalnum() or x[-1].isspace()]:
        raise ValueError(f"an exception must end in a symbol: {wrong[:5]}")
    plain = r"[\p{L}\p{M}\p{N}]+"
    rules = [*map(re.escape, listed), r"(?:\p{Lu}\.){2,}"]
    if words := sorted(set(elided), key=lambda x: (-len(x), x)):
        rules.append(f"(?i:{'|'.join(map(re.escape, words))})['’]")
    inside = f"(?:[{re.escape(joiners)}]{plain})*" if joiners else ""
    return "|".join([*rules, plain + inside, _SYMBOL])


def rule_tokenise(text: Column | str, rules: str | None = None) -> Column:
    """Tokens of a text by `token_rules`, in order: words, numbers, symbols, as they stand.

    Leading and trailing signs are tokens of their own, signs inside a word are not. One
    regular expression does it all; a null text gives null, a blank one no token.
    """
    return F.regexp_extract_all(_col(text), F.lit(rules or token_rules()), 0)


def clean_tokens(tokens: Column | str, min_length: int = 1) -> Column:
    """Lower-case a token array; null, empty and short tokens go, commas stay in their token."""
    lowered = F.transform(_col(tokens), F.lower)
    return F.filter(lowered, lambda t: F.length(t) >= max(min_length, 1))


def without_words(
    tokens: Column | str, words: Iterable[str], case_sensitive: bool = False
) -> Column:
    """Remove listed words from a token array, keeping order and repetition."""
    listed = {w if case_sensitive else w.lower() for w in words if w}
    if not listed:
        return _col(tokens)
    listed = sorted(listed)

    def keep(t: Column) -> Column:
        return t.isNull() | ~(t if case_sensitive else F.lower(t)).isin(*listed)

    return F.filter(_col(tokens), keep)


def join_tokens(tokens: Column | str, separator: str = ",") -> Column:
    return F.concat_ws(separator, _col(tokens))


def split_tokens(text: Column | str, separator: str = ",") -> Column:
    """Split on a regular expression; an empty text gives no token, not one empty token."""
    return F.filter(F.split(_col(text), separator), lambda t: F.length(t) > 0)
