"""De-identification of single values as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _blank(col: Column) -> Column:
    return col.isNull() | (col == "")


def _stars(count: Column, char: str = "*") -> Column:
    return F.repeat(F.lit(char), count)


def _head_masked(word: Column) -> Column:
    """Keep the first character and star the rest."""
    return F.concat(F.left(word, F.lit(1)), _stars(F.length(word) - 1))


def pseudonymize(value: ColumnLike, salt: str) -> Column:
    """Joinable token: 16 hex characters of a salted SHA-256; blank stays blank."""
    col = as_col(value)
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), col), 256)
    return F.when(_blank(col), "").otherwise(F.left(digest, F.lit(16)))


def mask_middle(value: ColumnLike, char: str = "*", keep_start: int = 0, keep_end: int = 0) -> Column:
    """Star everything but the first `keep_start` and last `keep_end` characters."""
    col = as_col(value)
    size = F.length(col)
    kept = keep_start + keep_end
    masked = F.concat(
        F.left(col, F.lit(keep_start)),
        _stars(size - kept, char),
        F.right(col, F.lit(keep_end)),
    )
    return F.when(_blank(col), "").when(size <= kept, _stars(size, char)).otherwise(masked)


def mask_email(value: ColumnLike) -> Column:
    """First letter of the user, starred first domain label, last label kept."""
    col = as_col(value)
    user = F.substring_index(col, "@", 1)
    labels = F.split(F.substring(col, F.instr(col, "@") + 1, F.length(col)), r"\.")
    user_part = F.when(F.length(user) > 1, _head_masked(user)).otherwise("*")
    extension = F.when(F.size(labels) > 1, F.element_at(labels, -1)).otherwise("***")
    masked = F.concat(user_part, F.lit("@"), _stars(F.length(labels[0])), F.lit("."), extension)
    return F.when(col.contains("@"), masked).otherwise("***@***.***")


def mask_phone(value: ColumnLike) -> Column:
    """Mobile prefix and last four digits; short values become stars."""
    col = as_col(value)
    digits = F.regexp_replace(col, P.NOT_DIGIT, "")
    long_form = F.concat(F.lit("+569"), _stars(F.length(digits) - 7), F.right(digits, F.lit(4)))
    return (
        F.when(_blank(col), "")
        .when(F.length(digits) >= 8, long_form)
        .otherwise(_stars(F.length(col)))
    )


def mask_name(value: ColumnLike) -> Column:
    """Every word keeps its first letter; white space collapses to one blank."""
    col = as_col(value)
    words = F.array_remove(F.split(col, f"{P.SPACE}+"), "")
    return F.coalesce(F.array_join(F.transform(words, _head_masked), " "), F.lit(""))


def tokenize_number(
    value: ColumnLike, key: str, keep: int = 4, max_len: int = 16, passthrough: bool = True
) -> Column:
    """Number token that keeps the length and the leading digits.

    The digits after the first `keep` come from a keyed SHA-256 of the raw text,
    so the same number written differently gets another token. It cannot be
    reversed. Text without any digit is returned as is, or null with
    `passthrough=False`.
    """
    col = as_col(value)
    digits = F.regexp_replace(col, P.NOT_DIGIT, "")
    hashed = F.regexp_replace(F.sha2(F.concat(F.lit("fpe:"), col, F.lit(f":{key}")), 256), "[^0-9]", "")
    # Padding repeats the digest when it has too few digits.
    token = F.rpad(F.left(digits, F.lit(keep)), F.least(F.length(digits), F.lit(max_len)), hashed)
    no_digits = col if passthrough else F.lit(None).cast("string")
    return F.when(_blank(col), "").when(col.rlike(P.DIGIT), token).otherwise(no_digits)


# (tag, pattern, plain pattern that every match contains); the order is part of
# the contract.
REDACTIONS: tuple[tuple[str, str, str], ...] = (
    ("[CHILE_RUT]", P.RUT, "-"),
    ("[PHONE_NUMBER]", P.MOBILE, "56"),
    ("[EMAIL_ADDRESS]", P.EMAIL, "@"),
    ("[CREDIT_CARD_NUMBER]", P.CARD, P.DIGIT + "{4}"),
)


def redact_text(value: ColumnLike, rules: Sequence[tuple[str, str, str]] = REDACTIONS) -> Column:
    """Replace personal data in free text by its type tag; null becomes ''.

    The cheap test spares most texts the costly pattern.
    """
    def replaced(tag: str, pattern: str, needs: str):
        literal = needs.isalnum() or len(needs) == 1

        def step(x: Column) -> Column:
            return F.when(x.contains(needs) if literal else x.rlike(needs), F.regexp_replace(x, pattern, tag)).otherwise(x)

        return step

    # One element passes from rule to rule, so the expression grows by one step per rule and not threefold.
    text = F.array(F.coalesce(as_col(value), F.lit("")))
    for rule in rules:
        text = F.transform(text, replaced(*rule))
    return F.get(text, F.lit(0))
