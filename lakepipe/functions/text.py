"""Text cleaning expressions."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakepipe.functions import as_col, as_text, case

# The general status words, in matching order.
STATUS_RULES = [
    (("active",), "active"),
    (("closed", "inactive", "disabled"), "closed"),
    (("pending", "waiting"), "pending"),
    (("deleted", "removed"), "deleted"),
]


def clean_string(c, default: str = "") -> Column:
    """Trimmed text; NULL becomes ``default``."""
    return F.trim(F.coalesce(as_text(c), F.lit(default)))


def clean_email(c) -> Column:
    return F.lower(clean_string(c))


def clean_upper(c) -> Column:
    return F.upper(clean_string(c))


def clean_phone(c) -> Column:
    """Digits only."""
    return F.regexp_replace(F.coalesce(as_text(c), F.lit("")), "[^0-9]", "")


def extract_email_domain(c) -> Column:
    """Second ``@`` part of the cleaned address, '' when there is none."""
    return F.split_part(clean_email(c), F.lit("@"), F.lit(2))


def email_domain_after_at(c) -> Column:
    """Everything after the first ``@``, '' when there is none."""
    c = as_text(c)
    at = F.instr(c, "@")
    return F.when(at > 0, F.substring(c, at + 1, F.length(c))).otherwise("")


def email_last_part(c) -> Column:
    """Last ``@`` part; the whole text when there is no ``@``."""
    return F.trim(F.substring_index(clean_email(c), "@", -1))


def normalize(
    c,
    rules: Sequence[tuple[Sequence[str] | str, str]],
    default: str = "unknown",
    keep_other: bool = True,
    whole_word: bool = False,
) -> Column:
    """Ordered, case-insensitive substring matching; the first match wins.

    Order matters: with ``active`` listed before ``inactive`` the text
    "Inactive" is ``active``.  ``whole_word=True`` compares whole words instead.
    Unmatched non-empty text is kept lower-cased (or becomes ``default`` with
    ``keep_other=False``); NULL and '' become ``default``.
    """
    c = as_text(c)
    arms = []
    for words, value in rules:
        words = [words] if isinstance(words, str) else list(words)
        if whole_word:
            found = c.rlike(r"(?i)\b(" + "|".join(re.escape(w) for w in words) + r")\b")
        else:
            found = functools.reduce(operator.or_, [c.ilike(f"%{w}%") for w in words])
        arms.append((found, F.lit(value)))
    if keep_other:
        arms.append((c != "", F.lower(F.trim(c))))
    return case(arms, F.lit(default))


def normalize_status(c) -> Column:
    return normalize(c, STATUS_RULES, "unknown")


def flag_label(c, labels: dict, default: str = "unknown") -> Column:
    """Map flag values to labels, e.g. ``{1: "active", 0: "inactive"}``."""
    c = as_col(c)
    return case([(c == F.lit(value), F.lit(label)) for value, label in labels.items()], F.lit(default))


def full_name(first, last, default: str = "Unknown") -> Column:
    """"First Last", whichever part exists, or ``default``."""
    first, last = clean_string(first), clean_string(last)
    joined = F.trim(F.concat(first, F.lit(" "), last))
    return F.when(joined != "", joined).otherwise(F.lit(default))


def id_or_blank(c) -> Column:
    """Integer placeholder 0 or NULL becomes '', anything else its text."""
    c = as_col(c)
    return F.when(c.isNull() | (c == 0), "").otherwise(c.cast("string"))


def if_null(c, default, is_string: bool = False) -> Column:
    """NULL (and '' for strings) replaced by ``default``."""
    c = as_col(c)
    if is_string:
        return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)
    return F.coalesce(c, F.lit(default))


def na_to_null(c, tokens: Sequence[str]) -> Column:
    c = as_text(c)
    return F.when(~c.isin(list(tokens)), c)


def blank_to_null(c) -> Column:
    """NULL for blank text and the words null / none in any case."""
    c = as_text(c)
    return F.when(~c.rlike(r"(?i)^(\s*|null|none)$"), c)
