"""Column building blocks for the text operators.

Each takes a column and names it once, so steps can be nested freely without
the expression tree growing faster than the number of steps.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskline.functions import patterns as p

# Up to this many removals are written out one after the other; more are looped.
_UNROLLED_REMOVALS = 4
# A forwarded block opens and closes with three dashes each.
_DASHES_PER_BLOCK = 6


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body
    names it."""
    return F.transform(F.array(value), body)[0]


def replace_all(text: Column, pattern: str, replacement: str = "") -> Column:
    """Replace every match of a Java regular expression; ``$1`` is group 1."""
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def only_if(
    text: Column, test: Callable[[Column], Column], step: Callable[[Column], Column]
) -> Column:
    """``step(text)`` for texts that pass a cheap test, the text itself otherwise."""
    return let(text, lambda t: F.when(test(t), step(t)).otherwise(t))


def when_contains(text: Column, needles: str | tuple[str, ...], step: Callable[[Column], Column]) -> Column:
    """``step(text)`` for texts that hold any of the needles."""
    needles = (needles,) if isinstance(needles, str) else needles
    return only_if(text, lambda t: contains_any(t, needles), step)


def contains_any(text: Column, needles: tuple[str, ...]) -> Column:
    return reduce(or_, (F.contains(text, F.lit(n)) for n in needles))


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def may_contain_any(text: Column, needles: tuple[str, ...]) -> Column:
    """False only if the text holds none of the needles, lower-case ASCII words, in any
    case. Beside the letters themselves, four characters fold to ASCII ones."""

    def folded(t: Column) -> Column:
        return F.lower(F.when(is_ascii(t), t).otherwise(F.translate(t, "\u0130\u0131\u017f\u212a", "iisk")))

    return let(text, lambda t: let(folded(t), lambda lowered: contains_any(lowered, needles)))


def strip(text: Column) -> Column:
    """Strip Unicode whitespace from both ends."""
    return F.btrim(text, F.lit(p.WHITESPACE))


def normalize_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def collapse_whitespace(text: Column) -> Column:
    """At most one blank line, single spaces, nothing at either end."""
    text = when_contains(text, "\n\n\n", lambda t: replace_all(t, p.NEWLINES, "\n\n"))
    text = when_contains(text, ("  ", "\t"), lambda t: replace_all(t, p.SPACES, " "))
    return strip(text)


def cut_from(text: Column, pattern: str) -> Column:
    """Drop the first match, which must run to the end of the text, and the
    whitespace before it. Texts without a match keep their trailing whitespace."""

    def cut(t: Column) -> Column:
        return let(
            replace_all(t, pattern),
            lambda head: F.when(
                F.octet_length(head) < F.octet_length(t), F.rtrim(head, F.lit(p.WHITESPACE))
            ).otherwise(t),
        )

    return let(text, cut)


def remove_forwards(text: Column, limit: int) -> Column:
    """Remove forwarded blocks one by one, each time the first that is left, up
    to ``limit`` of them; 0 removes them all.

    Removing a block can join its surroundings into a new one, so the blocks are
    not independent matches of one pattern.
    """

    def remove_first(t: Column) -> Column:
        return when_contains(t, "---", lambda t: replace_all(t, p.FIRST_FORWARD, "$1"))

    if 0 < limit <= _UNROLLED_REMOVALS:
        for _ in range(limit):
            text = remove_first(text)
        return text

    def remove_next(t: Column) -> Column:
        return remove_first(t) if limit else remove_first(remove_apart(t))

    def remove_many(t: Column) -> Column:
        dashes = F.octet_length(t) - F.octet_length(F.replace(t, F.lit("-")))
        rounds = F.floor(dashes / _DASHES_PER_BLOCK)
        if limit:
            rounds = F.least(rounds, F.lit(limit))

        def step(state: Column, _: Column) -> Column:
            return F.when(
                state["live"],
                let(
                    remove_next(state["text"]),
                    lambda left: F.struct(left.alias("text"), (left != state["text"]).alias("live")),
                ),
            ).otherwise(state)

        return F.aggregate(
            F.array_repeat(F.lit(0), rounds.cast("int")),
            F.struct(t.alias("text"), F.lit(True).alias("live")),
            step,
            lambda state: state["text"],
        )

    return let(text, remove_many)


def remove_apart(text: Column) -> Column:
    """Remove forwarded blocks in one pass, from the first one on up to one whose
    removal may join its surroundings into a new block."""
    return replace_all(text, p.FORWARDS_APART, "$1")


def count_words(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for an empty text."""
    return F.regexp_count(text, F.lit(p.WORD))


def first_words(text: Column, limit: int) -> Column:
    """The first ``limit`` words joined by single spaces; a text that has no more
    words than that is left as it is."""

    def shorten(t: Column) -> Column:
        return F.array_join(F.slice(F.split(strip(t), p.WORD_GAP, limit + 1), 1, limit), " ")

    # A word too many takes at least two characters for each word before it.
    return let(
        text,
        lambda t: F.when(
            (F.octet_length(t) > 2 * limit) & t.rlike(p.more_words_than(limit)), shorten(t)
        ).otherwise(t),
    )


def said_by_customer(text: Column, customer_line: str, fallback: Callable[[Column], Column]) -> Column:
    """The customer's side of a dialogue: what follows the customer labels, one
    line each, or ``fallback(text)`` where no line carries such a label."""

    def extract(t: Column) -> Column:
        return let(
            F.regexp_extract_all(t, F.lit(customer_line), F.lit(2)),
            lambda lines: F.when(
                F.size(lines) > 0,
                F.array_join(F.filter(F.transform(lines, strip), lambda line: line != ""), "\n"),
            ).otherwise(fallback(t)),
        )

    return let(text, extract)
