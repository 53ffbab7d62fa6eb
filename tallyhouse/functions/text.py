"""Text cleaning and report formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def after_prefix(value: Column, length: int = 2) -> Column:
    """The text without its first characters; empty when it is shorter."""
    return F.substr(value, F.lit(length + 1))


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def capitalize_words(value: Column) -> Column:
    """Upper-case the first character after anything that is not a letter or digit."""
    pieces = F.split(value, r"(?<=[^\p{L}\p{N}])")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(after_prefix(p, 1)))),
        "",
    )


def labelled(code: Column, labels: dict[str, str], default: Column) -> Column:
    """The label of a code, or the default for a code without one."""
    known = F.create_map(*[F.lit(text) for pair in labels.items() for text in pair])
    return F.coalesce(F.try_element_at(known, code), default)


def shorten(value: Column, length: int = 38) -> Column:
    """Cut long text to the given length, the last character being an ellipsis."""
    return F.when(F.length(value) <= length, value).otherwise(
        F.concat(F.left(value, F.lit(length - 1)), F.lit("…"))
    )


def amount_text(value: Column, places: int = 2) -> Column:
    """Rounded as a binary number, as text formatting of floats does."""
    return F.coalesce(F.format_number(value.cast("double"), places), F.lit("-"))


def percent_text(value: Column, places: int = 2) -> Column:
    return F.coalesce(F.concat(F.format_number(value.cast("double"), places), F.lit("%")), F.lit("-"))


def integer_text(value: Column) -> Column:
    return F.coalesce(F.format_number(value.cast("bigint"), 0), F.lit("-"))
