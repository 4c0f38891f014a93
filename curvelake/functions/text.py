"""Text columns: match keys, stable ids, label and title parsing, embedded JSON."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Generational suffixes dropped from the end of a name.
NAME_SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")

# Label and title patterns.
SIDE_LINE_PATTERN = r"(?:Over|Under)\s+(-?[0-9]+(?:\.[0-9]+)?)$"
RUNNER_PATTERN = r"^(.+)\s+(Over|Under)\s+(-?[0-9]+(?:\.[0-9]+)?)$"
SLASH_SEASON_PATTERN = r"NFL\s+(\d{4})/(\d{2})"
DASH_SEASON_PATTERN = r"\b(20\d{2}-\d{2})\b"


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, dict[str, str]]:
    """Fold tables derived from the Unicode data: one-to-one and one-to-many.

    A character folds to what is left of its compatibility decomposition after
    marks are dropped and case is folded. Characters that leave nothing in
    ``[a-z0-9 ]`` need no entry: the final clean-up removes them.
    """
    source, target, longer = [], [], {}
    for code in range(128, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char) and char.casefold() == char and not char.isspace():
            continue
        bare = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        folded = re.sub(r"\s", " ", re.sub(r"[^a-z0-9\s]", "", bare.casefold().replace("-", " ")))
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        elif len(folded) > 1:
            longer[char] = folded
    return "".join(source), "".join(target), longer


def fold_accents(c: Column) -> Column:
    """Lower-case ASCII form of a text, evaluated in the JVM.

    Plain ASCII text only pays for ``lower``; the lookup of characters that
    expand to several letters runs only on texts that hold one.
    """
    source, target, longer = _folding()
    entries = F.create_map(*[F.lit(x) for pair in longer.items() for x in pair])
    expanded = F.array_join(
        F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(entries, ch), ch)), "")
    has_longer = F.translate(c, "".join(longer), "") != c
    unfolded = F.when(has_longer, expanded).otherwise(c)
    return F.lower(F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(unfolded, source, target)).otherwise(c))


def match_key(c: Column) -> Column:
    """Comparable form of a display name; NULL gives an empty key."""
    text = F.regexp_replace(fold_accents(F.coalesce(c.cast("string"), F.lit(""))), "-", " ")
    text = F.trim(F.regexp_replace(F.regexp_replace(text, r"[^a-z0-9\s]", ""), r"\s+", " "))
    return F.regexp_replace(text, r"((^|\s)(" + "|".join(NAME_SUFFIXES) + r"))+$", "")


def stable_id(key: Column) -> Column:
    """Readable id for an unmatched name: slug plus a short digest of its key."""
    slug = F.regexp_replace(F.regexp_replace(key, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.concat(F.lit("player:"), F.coalesce(F.nullif(slug, F.lit("")), F.lit("unknown-player")),
                    F.lit("-"), F.substring(F.sha2(key, 256), 1, 12))


def initials_match(query: Column, candidate: Column) -> Column:
    """``j t smith`` against ``john thomas smith``: leading single letters agree, last names equal."""
    q, c = F.split(query, " "), F.split(candidate, " ")
    leading = F.slice(q, 1, F.greatest(F.size(q) - 1, F.lit(0)))
    agrees = F.forall(
        F.transform(leading, lambda ch, i: F.coalesce(F.startswith(F.get(c, i), ch), F.lit(False))), lambda ok: ok)
    return ((F.size(q) >= 2) & (F.size(c) >= 2) & F.forall(leading, lambda ch: F.length(ch) == 1)
            & (F.element_at(q, -1) == F.element_at(c, -1)) & agrees)


def extract(c: Column, pattern: str, group: int) -> Column:
    """Regex group, NULL when the pattern does not match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def label_line(c: Column) -> Column:
    return extract(c, SIDE_LINE_PATTERN, 1).cast("double")


def season_from_title(c: Column) -> Column:
    return F.when(c.rlike(SLASH_SEASON_PATTERN), F.concat_ws(
        "-", F.regexp_extract(c, SLASH_SEASON_PATTERN, 1), F.regexp_extract(c, SLASH_SEASON_PATTERN, 2)))


def split_title(title: Column, card: Column) -> tuple[Column, Column]:
    """(player, season) of a title such as ``<player> <card> <season>``."""
    text, marker = F.trim(title), F.concat(F.lit(" "), card, F.lit(" "))
    parts = F.split(text, F.concat(F.lit(r"\Q"), marker, F.lit(r"\E")))
    found = F.size(parts) > 1
    player = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1))), " ")
    suffix = F.when(found, F.element_at(parts, -1)).otherwise(text)
    return F.when(found, F.nullif(player, F.lit(""))), extract(suffix, DASH_SEASON_PATTERN, 1)


def participant_names(title: Column, participants: Column) -> tuple[Column, Column, Column]:
    """(player, team, team abbreviation) from event participants.

    ``participants`` is ``array<struct<name, team_id, short_name>>``; people carry
    no team id. Without exactly one person, the player is the title's last part.
    """
    people = F.filter(participants, lambda p: F.coalesce(p["team_id"], F.lit("")) == "")
    teams = F.filter(participants, lambda p: F.coalesce(p["team_id"], F.lit("")) != "")
    fallback = F.when(F.contains(title, F.lit(" - ")), F.substring_index(title, " - ", -1))
    player = F.coalesce(F.when(F.size(people) == 1, F.nullif(F.get(people, F.lit(0))["name"], F.lit(""))), fallback)
    return player, F.get(teams, F.lit(0))["name"], F.get(teams, F.lit(0))["short_name"]


def embedded_json(page: Column, variable: str, schema: str) -> Column:
    """Parse the object assigned to ``window.<variable>`` in a page; NULL if absent."""
    marker = f"window.{variable} = "
    start = F.instr(page, marker)
    tail = page.substr(start + F.lit(len(marker)), F.length(page))
    return F.when(start > 0, F.from_json(tail, schema))


def embedded_literal(page: Column, marker: str) -> Column:
    """The JSON string or number that follows ``marker`` in a page, as text; NULL if there is none."""
    literal = extract(page, "\\Q" + marker + r'\E\s*("(?:[^"\\]|\\.)*"|-?[0-9]+(?:\.[0-9]+)?)', 1)
    return F.get(F.from_json(F.concat(F.lit("["), literal, F.lit("]")), "array<string>"), 0)
