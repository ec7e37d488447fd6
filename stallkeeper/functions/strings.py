"""String clean-up modes as SQL expressions.

Each builder takes the SQL text of a string column and returns SQL text, so
the same expression serves DataFrame jobs (``mode_column``) and the SQL
function ``string_utils`` (see ``sqlfuncs``).  ``v1`` and ``v2`` are the two
published behaviours of the function.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Address and phone patterns.
EMAIL_PATTERN = r"^[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"(\+?\d{1,3})?[-.\s]?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"

_EMAIL_WHOLE = EMAIL_PATTERN[:-1] + r"\z"


def lit(text: str) -> str:
    """Raw SQL literal for a pattern."""
    return f"r'{text}'"


def drop(c: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({c}, {lit(pattern)}, '{by}')"


def strip(c: str) -> str:
    """Trim control characters and spaces, not only spaces."""
    return drop(c, r"^[\x00-\x20]+|[\x00-\x20]+\z")


def _words(c: str) -> str:
    return f"split({strip(c)}, {lit(chr(92) + 's+')})"


def _first_letter_up(w: str) -> str:
    shape = lit(r"(?s)^(\P{L}*)(\p{L}?)(.*)\z")
    return (f"concat(regexp_extract({w}, {shape}, 1), upper(regexp_extract({w}, {shape}, 2)), "
            f"lower(regexp_extract({w}, {shape}, 3)))")


def clean(c: str) -> str:
    """First letter of each word in upper case; NULL when blank."""
    return f"nullif(array_join(transform({_words(c)}, w -> {_first_letter_up('w')}), ' '), '')"


def title_case(c: str) -> str:
    """First character of each word in upper case; '' when blank."""
    return f"array_join(transform({_words(c)}, w -> concat(upper(left(w, 1)), lower(substr(w, 2)))), ' ')"


def initials(c: str) -> str:
    return f"array_join(transform({_words(c)}, w -> upper(left(w, 1))), '')"


def is_email(c: str) -> str:
    return f"{c} rlike {lit(_EMAIL_WHOLE)}"


def is_phone(c: str) -> str:
    return f"{c} rlike {lit(PHONE_PATTERN)}"


def _verdict(test: str) -> str:
    return f"case when {test} then 'valid' else 'invalid' end"


def _mask_middle(s: str) -> str:
    return (f"case when length({s}) <= 2 then repeat('*', length({s})) "
            f"else concat(left({s}, 1), repeat('*', length({s}) - 2), right({s}, 1)) end")


def mask_email_v1(c: str) -> str:
    """Keep the ends of the local part and first domain label; second label stays."""
    local, domain = f"split_part({c}, '@', 1)", f"split_part({c}, '@', 2)"
    head, tail = f"split_part({domain}, '.', 1)", f"split_part({domain}, '.', 2)"
    masked = f"concat({_mask_middle(local)}, '@', {_mask_middle(head)}, '.', {tail})"
    return f"case when {is_email(c)} then {masked} else {c} end"


def mask_email_v2(c: str) -> str:
    """Keep the ends of the local part, the first domain character and the suffix."""
    local, domain = f"split_part({c}, '@', 1)", f"split_part({c}, '@', 2)"
    suffix = f"concat('.', substring_index({domain}, '.', -1))"
    name = f"left({domain}, length({domain}) - length({suffix}))"
    ends = f"concat(left({local}, 1), repeat('*', length({local}) - 2), if(length({local}) > 1, right({local}, 1), ''))"
    return (f"case when {is_email(c)} then concat({ends}, '@', left({name}, 1), "
            f"repeat('*', length({name}) - 1), {suffix}) else {c} end")


def mask_phone(c: str) -> str:
    digits = drop(c, "[^0-9]")
    masked = f"concat(repeat('*', length({digits}) - 4), right({digits}, 4))"
    return f"case when {is_phone(c)} and length({digits}) >= 4 then {masked} else {c} end"


def slug_v1(c: str) -> str:
    dashed = drop(drop(drop(f"lower({c})", r"[^a-z0-9\s-]"), r"\s+", "-"), "-+", "-")
    return drop(dashed, r"^-|-\z")


def slug_v2(c: str) -> str:
    return drop(strip(drop(f"lower({c})", r"[^a-z0-9\s-]")), r"\s+", "-")


def char_count(c: str) -> str:
    """Length in 16-bit units: characters above U+FFFF count twice."""
    return f"cast(length({c}) + length({drop(c, '[^' + chr(92) + 'x{10000}-' + chr(92) + 'x{10FFFF}]')}) as string)"


def _count_words_v2(c: str) -> str:
    return f"cast(if({strip(c)} = '', 0, size({_words(c)})) as string)"


_KEEP_ALNUM = r"[^a-zA-Z0-9\s]"

MODES = {
    "v1": {
        "clean": clean,
        "upper": lambda c: f"upper({c})",
        "lower": lambda c: f"lower({c})",
        "extract_numbers": lambda c: f"nullif({drop(c, '[^0-9]')}, '')",
        "extract_letters": lambda c: drop(c, "[^a-zA-Z]"),
        "mask_email": mask_email_v1,
        "mask_phone": mask_phone,
        "validate_email": lambda c: _verdict(is_email(c)),
        "validate_phone": lambda c: _verdict(is_phone(c)),
        "remove_special": lambda c: drop(c, _KEEP_ALNUM),
        "slug": slug_v1,
        "initials": initials,
        "reverse": lambda c: f"reverse({c})",
        "word_count": lambda c: f"cast(size({_words(c)}) as string)",
        "char_count": char_count,
    },
    "v2": {
        "title_case": title_case,
        "extract_numbers": lambda c: drop(c, "[^0-9]"),
        "mask_email": mask_email_v2,
        "validate_email": lambda c: _verdict(is_email(c)),
        "slug": slug_v2,
        "initials": initials,
        "word_count": _count_words_v2,
        "reverse": lambda c: f"reverse({c})",
        "remove_special": lambda c: strip(drop(c, _KEEP_ALNUM)),
    },
}


def mode_sql(c: str, mode: str, variant: str = "v1") -> str:
    """NULL in, NULL out; every mode is guarded because masks build from parts."""
    return f"case when {c} is null then null else {MODES[variant][mode](c)} end"


def mode_column(c: str, mode: str, variant: str = "v1") -> Column:
    return F.expr(mode_sql(c, mode, variant))
