"""String expressions shared by the operators; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, written out because `\s` alone is ASCII-only in Spark.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


# The same characters one by one.
BLANKS = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip_ends(text: Column) -> Column:
    """As `strip`, for long texts: no pattern is searched in what lies between the ends."""
    return F.btrim(text, F.lit(BLANKS))


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def collapse(text: Column) -> Column:
    """Turn every run of white space into one blank and strip the ends."""
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def words(text: Column) -> Column:
    """White-space separated tokens; an empty text has none."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def first_words(text: Column, n: int) -> Column:
    """The first n tokens; splitting stops there instead of running over all of a text."""
    pieces = F.split(text, f"{SPACE}+", n + 2)
    # A leading blank gives one empty piece, and the last piece may be all the rest.
    return F.slice(F.filter(F.slice(pieces, 1, n + 1), lambda w: w != ""), 1, n)


def let(value: Column, use) -> Column:
    """use(value) with the value computed once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def any_of(conditions: list[Column]) -> Column:
    """OR of the conditions, false when there are none."""
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def contains_any(text: Column, needles) -> Column:
    return any_of([text.contains(n) for n in needles])


def matched(text: Column, needles) -> Column:
    """The needles that occur in the text, in the order given."""
    if not needles:
        return F.array().cast("array<string>")
    return F.filter(F.array(*[F.lit(n) for n in needles]), lambda n: text.contains(n))


def count_present(text: Column, needles) -> Column:
    """How many different needles occur in the text."""
    total = F.lit(0)
    for needle in needles:
        total = total + text.contains(needle).cast("int")
    return total


def first_label(text: Column, labelled) -> Column:
    """Label of the first (label, needles) entry with a needle in the text, else null."""
    return F.coalesce(
        *[F.when(contains_any(text, needles), F.lit(label)) for label, needles in labelled],
        F.lit(None).cast("string"),
    )


def matches_any(text: Column, patterns) -> Column:
    r"""Case-insensitive search for any of the patterns.

    With the flag U, `\b` and `\s` know all letters and blanks, not only ASCII ones.
    """
    return text.rlike("(?iU)" + "|".join(f"(?:{p})" for p in patterns))


def snippet(text: Column, size: int) -> Column:
    return F.substring(text, 1, size)


def theme_label(theme: Column, labels: dict) -> Column:
    """Display label of a theme; an unknown theme is shown as it is."""
    result = theme
    for key, label in labels.items():
        result = F.when(theme == key, F.lit(label)).otherwise(result)
    return result
