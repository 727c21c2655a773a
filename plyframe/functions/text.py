"""String, regex and list expressions, and the header fields of a game text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plyframe.functions.numbers import whole_number

# Formats of the archive and the two sites its links point to.
HEADER_BREAK = "\n\n"
NUMBERED_MOVE = r"\d+\.+ [\S]+"
CLOCK_NOTE = r"\{\[%clk \S+\]\}"
RESULTS = ["1-0", "0-1", "1/2-1/2", "*"]
# What separates moves: blanks, comments, glyphs and move numbers; most letters fail at the first look ahead.
BETWEEN_MOVES = r"(?=[\s{;$\d!?.])(?:\s|\{[^}]*+\}|;[^\n]*+|\$\d++|\d++\.++|[!?.]++)+"
ANALYSIS_SITE = "https://lichess.org/analysis/pgn/"
OPENING_SITE = "https://www.chess.com/openings/"


def part(text: Column, separator: str, index: int) -> Column:
    """``index``-th piece (1-based, negative from the end) or NULL; ``separator`` is a regex."""
    return F.try_element_at(F.split(text, separator), F.lit(index))


def joined(*columns: Column) -> Column:
    """Concatenate, skipping NULLs (``F.concat`` instead turns NULL if any part is)."""
    return F.concat_ws("", *columns)


def all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def match_count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def letter_count(text: Column, letters: str) -> Column:
    """How many characters of ``text`` are one of ``letters`` (no regex engine)."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def list_text(items: Column) -> Column:
    """Items separated by a blank; '' for an empty list."""
    return F.array_join(items, " ")


def prefix_text(items: Column, count: int) -> Column:
    """The first ``count`` items as text, NULL if there are none."""
    return F.when(F.size(items) > 0, list_text(F.slice(items, 1, count)))


def header(text: Column, name: str) -> Column:
    """Value of the header line ``[name "value"]``; '' if there is none."""
    return F.regexp_extract(text, f'{name} "(.*)"', 1)


def _until_break(text: Column) -> Column:
    """What comes before the first blank line, all of ``text`` if there is none."""
    # ``locate`` skips bytes that cannot begin a break; ``substring_index`` compares at every one.
    place = F.locate(HEADER_BREAK, text)
    return F.when(place > 0, F.substring(text, F.lit(1), place - 1)).otherwise(text)


def header_block(text: Column) -> Column:
    """What comes before the first blank line."""
    return _until_break(text)


def move_block(text: Column) -> Column:
    """What stands between the first and the second blank line, NULL if there is none."""
    place = F.locate(HEADER_BREAK, text)
    return F.when(place > 0, _until_break(F.substring(text, place + len(HEADER_BREAK), F.lit(2**31 - 1))))


def move_tokens(moves: Column) -> Column:
    """Moves of the main line, in order; side lines in brackets and the result are dropped."""
    words = F.split(moves, BETWEEN_MOVES)
    spaced = F.split(F.regexp_replace(moves, r"([()])", " $1 "), BETWEEN_MOVES)
    main_line = F.aggregate(
        spaced,
        F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept")),
        lambda state, word: F.struct(
            F.when(word == "(", state["depth"] + 1)
            .when(word == ")", F.greatest(state["depth"] - 1, F.lit(0)))
            .otherwise(state["depth"])
            .alias("depth"),
            F.when(word.isin("(", ")") | (state["depth"] > 0), state["kept"])
            .otherwise(F.array_append(state["kept"], word))
            .alias("kept"),
        ),
    )["kept"]
    found = F.when(F.contains(moves, F.lit("(")), main_line).otherwise(words)
    return F.filter(found, lambda word: (word != "") & ~word.isin(*RESULTS))


def time_control_base(time_class: Column, time_control: Column) -> Column:
    """Seconds on the clock: ``base+increment``, or ``1/seconds`` for daily games."""
    return (
        F.when(time_class == "daily", part(time_control, "/", 2))
        .otherwise(part(time_control, r"\+", 1))
        .cast("int")
    )


def time_control_increment(time_class: Column, time_control: Column) -> Column:
    return (
        F.when(time_class == "daily", F.lit("0"))
        .otherwise(F.coalesce(part(time_control, r"\+", 2), F.lit("0")))
        .cast("int")
    )


def game_mode(time_class: Column, time_control: Column, base: Column) -> Column:
    """``daily N days`` or ``<class> <control>``."""
    days = whole_number(base / 3600 / 24).cast("string")
    return F.when(
        time_class == "daily", F.concat(F.lit("daily "), days, F.lit(" days"))
    ).otherwise(F.concat(time_class, F.lit(" "), time_control))


def url_text(text: Column) -> Column:
    """Blanks encoded, mate marks dropped: the form the analysis site takes."""
    return F.replace(F.replace(text, F.lit(" "), F.lit("%20")), F.lit("#"), F.lit(""))


def analysis_url(moves_text: Column, color: Column) -> Column:
    return F.concat(
        F.lit(ANALYSIS_SITE), url_text(moves_text), F.lit("?color="), F.lower(color)
    )
