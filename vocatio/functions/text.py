# -*- coding: utf-8 -*-
"""Text rules as Column expressions.

Everything here stays inside the JVM. Whitespace always means the set that
Unicode-aware engines strip and split on; Java's own ``\\s`` and ``trim`` cover
less of it, so the class is spelled out.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from vocatio import fixed_values as fixed

# Single low characters become one bit set in Java's regex compiler; the rare
# high ones hide behind one range test, so ordinary text fails two tests only.
_LOW = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
_HIGH = r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS = rf"[{_LOW}[\u1680-\u3000&&[{_HIGH}]]]"
NOT_WS = rf"[^{_LOW}{_HIGH}]"
WS_CHARACTERS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAKS = r"[\n\x0b\f\r\x1c\x1d\x1e\x85\u2028\u2029]"
DIGIT = r"\p{Nd}"

# The counted form of the length test is only used while its regex stays small.
_MAX_COUNTED_LENGTH = 512


def text_or_empty(text: Column) -> Column:
    """Null becomes the empty string; any type becomes text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row.

    An expression that is used several times is otherwise inlined, and so
    evaluated, several times.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WS_CHARACTERS))


def collapse_whitespace(text: Column) -> Column:
    """Trim and squeeze every run of whitespace to one blank; null gives ''."""
    return F.trim(F.regexp_replace(text_or_empty(text), rf"{WS}+", " "))


def effective_length(text: Column) -> Column:
    """Number of code points that are not whitespace; 0 for null."""
    return F.length(F.regexp_replace(text_or_empty(text), rf"{WS}+", ""))


def has_effective_length(text: Column, minimum: int) -> Column:
    """``effective_length(text) >= minimum``, decided at the minimum-th character.

    The result is the same as counting, but a long text is not rewritten just
    to learn that it is long enough.
    """
    if minimum <= 0:
        return F.lit(True)
    if minimum > _MAX_COUNTED_LENGTH:
        return effective_length(text) >= minimum
    return text_or_empty(text).rlike(rf"^(?:{WS}*+{NOT_WS}){{{minimum}}}")


def year_from_name(name: Column) -> Column:
    found = F.regexp_extract(name, fixed.YEAR_PATTERN, 0)
    return F.when(found == "", F.lit(fixed.UNKNOWN_YEAR)).otherwise(found)


def normalize_level_code(code: Column) -> Column:
    """``1-2-3-4`` becomes ``1-02-03-04``; anything else is only stripped."""
    stripped = strip(text_or_empty(code))
    padded = F.transform(
        F.split(stripped, "-"),
        lambda part, i: F.when(i == 0, part).otherwise(F.lpad(part, 2, "0")),
    )
    is_code = stripped.rlike(rf"^{DIGIT}{{1,2}}(?:-{DIGIT}{{1,2}}){{0,3}}\z")
    return F.when(is_code, F.array_join(padded, "-")).otherwise(stripped)


def occupation_text(name: Column, task: Column) -> Column:
    """``name：task``, or whichever of the two is not empty."""
    name, task = collapse_whitespace(name), collapse_whitespace(task)
    both = (name != "") & (task != "")
    return F.when(both, F.concat(name, F.lit(fixed.HEADER_COLON), task)).otherwise(
        F.concat(name, task)
    )


def is_invalid_input(text: Column, minimum: int = fixed.MIN_INPUT_LEN) -> Column:
    """Too short to be matched, or the model's own 'not recognizable' answer."""
    stripped = strip(text_or_empty(text))
    if minimum > len(fixed.UNRECOGNIZED):
        return F.length(stripped) < minimum
    return (F.length(stripped) < minimum) | stripped.isin("", fixed.UNRECOGNIZED)


def contains_any(text: Column, keywords: Column) -> Column:
    return F.exists(keywords, lambda word: F.contains(text, word))


# --- duty sections ------------------------------------------------------------


def _alternatives(words: list[str]) -> str:
    return "|".join(re.escape(word) for word in words)


def _rewrites(words: list[str], pattern: str, replacement: str) -> Column:
    """A literal array of (word, pattern, replacement) for a fold over words."""
    return F.array(
        *[
            F.struct(
                F.lit(word).alias("word"),
                F.lit(pattern.format(word=re.escape(word))).alias("pattern"),
                F.lit(
                    replacement.format(word=word.replace("\\", r"\\").replace("$", r"\$"))
                ).alias("replacement"),
            )
            for word in words
        ]
    )


def _apply_in_order(text: Column, rewrites: Column, applies) -> Column:
    """Fold the rewrites over a text, in list order.

    A cheap literal test guards each regex, so a text pays only for the words
    that occur in it.
    """
    return F.aggregate(
        rewrites,
        text,
        lambda acc, rule: F.when(
            applies(acc, rule["word"]),
            F.regexp_replace(acc, rule["pattern"], rule["replacement"]),
        ).otherwise(acc),
    )


def section_lines(
    text: Column,
    duty_headers: list[str] = fixed.DUTY_HEADERS,
    negative_headers: list[str] = fixed.NEGATIVE_HEADERS,
) -> Column:
    """Split a text so that every header starts a line of its own."""
    unified = text
    for found, replacement in (("\r\n", "\n"), ("\r", "\n"), ("\t", " ")):
        unified = F.replace(unified, F.lit(found), F.lit(replacement))
    # The look-behind follows the header, so that the search is for a literal.
    rewrites = _rewrites(
        duty_headers + negative_headers,
        rf"{{word}}(?<!\n{{word}}){WS}*[:：]?",
        "\n{word}" + fixed.HEADER_COLON,
    )
    broken = _apply_in_order(unified, rewrites, lambda acc, word: F.contains(acc, word))
    return F.filter(F.transform(F.split(broken, "\n"), strip), lambda line: line != "")


def duty_section(
    text: Column,
    duty_headers: list[str] = fixed.DUTY_HEADERS,
    negative_headers: list[str] = fixed.NEGATIVE_HEADERS,
) -> Column:
    """Lines from the first duty header up to the next negative header.

    Without a duty header, or when its section is empty, the lines from the
    start up to the first negative header. May be ''.
    """
    opens = rf"^(?:{_alternatives(duty_headers)})"
    closes = rf"^(?:{_alternatives(negative_headers)})"
    strips = _rewrites(duty_headers, rf"^{{word}}{WS}*[:：]?{WS}*", "")

    def before_negative(lines: Column) -> Column:
        stop = F.array_position(F.transform(lines, lambda line: line.rlike(closes)), True)
        return F.when(stop > 0, F.slice(lines, 1, (stop - 1).cast("int"))).otherwise(lines)

    def strip_headers(line: Column) -> Column:
        stripped = _apply_in_order(line, strips, lambda acc, word: F.startswith(acc, word))
        return F.when(line.rlike(opens), strip(stripped)).otherwise(line)

    def choose(lines: Column) -> Column:
        start = F.array_position(F.transform(lines, lambda line: line.rlike(opens)), True)
        tail = F.slice(lines, F.greatest(start, F.lit(1)).cast("int"), F.size(lines))
        duties = F.filter(
            F.transform(before_negative(tail), strip_headers), lambda line: line != ""
        )
        found = (start > 0) & (F.size(duties) > 0)
        return F.array_join(
            F.when(found, duties).otherwise(before_negative(lines)), "\n"
        )

    return bind(section_lines(text_or_empty(text), duty_headers, negative_headers), choose)


def duty_text(
    text: Column,
    duty_headers: list[str] = fixed.DUTY_HEADERS,
    negative_headers: list[str] = fixed.NEGATIVE_HEADERS,
) -> Column:
    """The duty section, or the stripped text where there is none."""
    raw = strip(text_or_empty(text))
    section = duty_section(raw, duty_headers, negative_headers)
    return bind(section, lambda found: F.when(found != "", found).otherwise(raw))


def prompt_body(
    text: Column,
    max_chars: int = fixed.MAX_INPUT_CHARS,
    duty_headers: list[str] = fixed.DUTY_HEADERS,
    negative_headers: list[str] = fixed.NEGATIVE_HEADERS,
) -> Column:
    """The part of a posting that a model sees: its duties, else the raw text."""
    whole = duty_text(text, duty_headers, negative_headers)
    return F.substring(whole, 1, max_chars)


def prompt_texts(examples: list[str] = fixed.EXAMPLE_TASKS) -> tuple[str, str]:
    """System text and the user text that precedes the posting."""
    shown = "\n".join(
        fixed.EXAMPLE_LINE.format(number=i, task=task) for i, task in enumerate(examples, 1)
    )
    return fixed.SYSTEM_PROMPT, fixed.USER_PROMPT.format(
        example_tasks=shown or fixed.NO_EXAMPLES
    )


def prompt(text: Column, prefix: str, suffix: str = "", **options) -> Column:
    """Constant prefix + posting + constant suffix."""
    return F.concat(F.lit(prefix), prompt_body(text, **options), F.lit(suffix))


# --- numbered lists -----------------------------------------------------------


def format_numbered(text: Column) -> Column:
    """One numbered item per line, each with a closing mark."""
    marker = rf"({DIGIT}+){fixed.NUMBER_DELIMITERS}{WS}*"

    def finish(line: Column) -> Column:
        return bind(
            F.regexp_replace(line, rf"^{marker}", r"$1. "),
            lambda item: F.when(item.rlike(rf"[{fixed.SENTENCE_ENDS}]\z"), item).otherwise(
                F.concat(item, F.lit(fixed.ITEM_END))
            ),
        )

    def number(stripped: Column) -> Column:
        broken = F.when(
            stripped.rlike(rf"{DIGIT}{fixed.NUMBER_DELIMITERS}"),
            F.regexp_replace(stripped, rf"(?={WS}|{DIGIT})(?<!^)(?<!\n){WS}*{marker}", "\n$1. "),
        ).otherwise(stripped)
        lines = F.transform(F.split(broken, LINE_BREAKS), strip)
        items = F.transform(F.filter(lines, lambda line: line != ""), finish)
        as_is = (stripped == "") | (stripped == fixed.UNRECOGNIZED)
        return F.when(as_is, stripped).otherwise(F.array_join(items, "\n"))

    return bind(strip(text_or_empty(text)), number)


def is_standardized(text: Column) -> Column:
    return (text != "") & (text != fixed.UNRECOGNIZED)
