"""Fields of a shape and rules on names and paths, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys that may hold a track id, in order of preference.
TRACK_KEYS = ("id", "track_id", "player_id")
# Label used for boxes without an action.
UNKNOWN = "__unknown__"
# Frame step by dataset name found in the path.
STRIDE_BY_PATH = {"sportshhi": 5}
# Header words skipped in split lists.
SPLIT_HEADERS = ("tube", "path", "video", "videos", "sample")
# Characters kept in directory names.
SPACE = "[\\s\\p{Z}\\x1c-\\x1f\\x{85}]"
UNSAFE_NAME = "[^0-9A-Za-z_\\-\\.一-龥]"


def action_of(attributes: Column, flags: Column) -> Column:
    """Action text: the attribute, else the flag, else an empty string."""
    return F.coalesce(
        F.nullif(attributes["action"], F.lit("")), F.nullif(flags["action"], F.lit("")), F.lit("")
    )


def track_of(attributes: Column, flags: Column, group_id: Column) -> Column:
    """Track id text from attributes, then flags, then the group id; null when none is set."""
    candidates = [m[k] for m in (attributes, flags) for k in TRACK_KEYS]
    return F.coalesce(*candidates, group_id)


def base_name(path: Column) -> Column:
    return F.regexp_extract(F.translate(path, "\\", "/"), "([^/]*)$", 1)


def stem(path: Column) -> Column:
    """Base name without its last extension; a leading dot does not start an extension."""
    return F.regexp_replace(base_name(path), "(?<=.)\\.[^.]*$", "")


def frame_index(path: Column, rule: str = "suffix") -> Column:
    """Frame number of a file name.

    ``suffix`` takes the trailing digits of the stem, ``all`` every digit in it,
    ``int`` the stem itself when it is a whole number.
    """
    name = stem(path)
    if rule == "suffix":
        text = F.regexp_extract(name, "([0-9]+)$", 1)
    elif rule == "all":
        text = F.regexp_replace(name, "[^0-9]", "")
    elif rule == "int":
        text = F.regexp_extract(name, "^\\s*([+-]?[0-9]+)\\s*$", 1)
    else:
        raise ValueError(f"unknown index rule: {rule}")
    return text.try_cast("bigint")


def stride_rule(path: Column) -> Column:
    """Frame step implied by the dataset name in a path."""
    out = F.lit(1)
    for word, step in STRIDE_BY_PATH.items():
        out = F.when(F.contains(F.lower(path), F.lit(word)), F.lit(step)).otherwise(out)
    return out.cast("bigint")


def sanitize(name: Column) -> Column:
    """Directory-safe name: white space and other unsafe characters become underscores."""
    text = F.regexp_replace(name, f"^{SPACE}+|{SPACE}+$", "")
    text = F.regexp_replace(text, f"{SPACE}+", "_")
    text = F.regexp_replace(text, UNSAFE_NAME, "_")
    return F.when(text == "", F.lit("unknown")).otherwise(text)


def norm_path(path: Column) -> Column:
    """Path from its ``videos`` directory on, else ``videos/<base name>``."""
    clean = F.translate(F.trim(path), "\\", "/")
    tail = F.regexp_extract(clean, "(?:^|/)(videos(?:/.*)?)$", 1)
    return F.when(tail != "", tail).otherwise(F.concat(F.lit("videos/"), base_name(clean)))


def add_prefix(path: Column, prefix: str) -> Column:
    return F.when(F.startswith(path, F.lit(prefix)), path).otherwise(
        F.concat(F.lit(prefix), path)
    )


def matches_prefixes(name: Column, include: list[str], exclude: list[str]) -> Column:
    """Starts with any include prefix (none given: all) and with no exclude prefix."""
    keep = F.lit(True)
    if include:
        keep = F.lit(False)
        for p in include:
            keep = keep | F.startswith(name, F.lit(p))
    for p in exclude:
        keep = keep & ~F.startswith(name, F.lit(p))
    return keep


def sport_of(action_name: Column) -> Column:
    """Text before the first `` - ``; null stays null."""
    return F.trim(F.split_part(action_name, F.lit(" - "), F.lit(1)))


def answer_flag(text: Column) -> Column:
    """0/1 answer in free text: a digit standing alone, else any 0 or 1, else the word for yes."""
    alone = F.regexp_extract(text, "(?<![\\p{L}\\p{N}_])([01])(?![\\p{L}\\p{N}_])", 1)
    anywhere = F.regexp_extract(text, "([01])", 1)
    return F.coalesce(
        F.nullif(alone, F.lit("")).cast("int"),
        F.nullif(anywhere, F.lit("")).cast("int"),
        F.when(F.contains(text, F.lit("是")), 1).otherwise(0),
    )


def pad_number(number: Column, width: int) -> Column:
    """Zero-padded number; longer numbers are kept whole."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
