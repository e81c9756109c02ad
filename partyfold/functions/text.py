"""Standardising rules as Column expressions (built-ins only, codegen-friendly).

Each rule is composed as Spark SQL expression text and turned into a Column
with one ``F.expr`` call: the JVM parses it into the same built-in Catalyst
expressions, but building a plan costs one driver round trip per column
instead of dozens. Inputs are column names or SQL snippets (see ``sql``).
Functions that need conf contents take a
:class:`~partyfold.sources.conf.Conf`; those tiny parameter tables are
folded into literals.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from ..sources.conf import Conf

# Java regex: \p{Nd} is any Unicode decimal digit (full-width ones included),
# which is what the original digit classes mean; Java's own \d is ASCII-only.
NON_DIGIT = r"\P{Nd}"
DIGIT = r"\p{Nd}"

_FULLWIDTH_ASCII = "".join(chr(c) for c in range(fixed.FULLWIDTH_ASCII_FIRST,
                                                   fixed.FULLWIDTH_ASCII_LAST + 1))
_HALFWIDTH_ASCII = "".join(chr(ord(c) - fixed.FULLWIDTH_OFFSET) for c in _FULLWIDTH_ASCII)
_HIRAGANA = "".join(chr(c) for c in range(fixed.HIRAGANA_FIRST, fixed.HIRAGANA_LAST + 1))
_KATAKANA = "".join(chr(ord(c) + fixed.KATAKANA_OFFSET) for c in _HIRAGANA)
_KANA_PAIRS = [(k, v) for k, v in fixed.HALF_TO_FULL_KANA.items() if len(k) == 2]
_MARKS = "".join(sorted({k[1] for k, _ in _KANA_PAIRS}))
_KANA_SINGLE_FROM = "".join(k for k in fixed.HALF_TO_FULL_KANA if len(k) == 1)
_KANA_SINGLE_TO = "".join(fixed.HALF_TO_FULL_KANA[k] for k in _KANA_SINGLE_FROM)
_SMALL_FROM = "".join(fixed.SMALL_KA_KE)
_SMALL_TO = "".join(fixed.SMALL_KA_KE.values())
_UNIT_PATTERN = "(" + DIGIT + "+)(" + "|".join(fixed.ADDRESS_UNITS) + ")"
_POSTAL_PATTERN = DIGIT + "{3}-?" + DIGIT + "{4}"


# ---- SQL text helpers ----------------------------------------------------------
def q(s: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class Sql:
    """A SQL expression snippet used as input of another rule."""

    def __init__(self, text: str):
        self.text = text

    def col(self) -> Column:
        return F.expr(self.text)


def sql(c) -> str:
    """Column name -> quoted identifier; a ``Sql`` snippet passes through."""
    return c.text if isinstance(c, Sql) else ident(c)


def col_(c) -> Column:
    if isinstance(c, Sql):
        return c.col()
    return F.col(c) if isinstance(c, str) else c


def _lit_map(pairs) -> str:
    return "map(" + ", ".join(f"{q(k)}, {q(v)}" for k, v in pairs) + ")"


def _or(parts) -> str:
    return "(" + " OR ".join(parts) + ")" if parts else "false"


# ---- rules as SQL text (s_*) -----------------------------------------------------
def s_blank(x: str) -> str:
    return f"coalesce({x}, '')"


def s_remove_spaces(x: str) -> str:                       # R1
    return f"regexp_replace({s_blank(x)}, {q('[' + fixed.SPACES + ']')}, '')"


def s_digits(x: str) -> str:                              # R2 / R11
    return f"regexp_replace({s_blank(x)}, {q(NON_DIGIT)}, '')"


#: From this many pairs on, R3 folds over an array of pairs instead of nesting replaces,
#: so that the expression stays flat (the result is the same).
NESTED_REPLACES = 30


def s_replace_partial(x: str, pairs) -> str:              # R3
    out = s_blank(x)
    pairs = list(pairs)
    if len(pairs) >= NESTED_REPLACES:
        listed = ", ".join(f"struct({q(before)} AS b, {q(after)} AS a)" for before, after in pairs)
        return f"aggregate(array({listed}), {out}, (acc, p) -> replace(acc, p.b, p.a))"
    for before, after in pairs:
        out = f"replace({out}, {q(before)}, {q(after)})"
    return out


def exact_chain(pairs) -> dict:
    """Final value of each ``before`` after whole-value replaces applied in order
    (a later pair can re-map an earlier result). Values that equal no
    ``before`` never change."""
    final = {}
    for start in dict.fromkeys(b for b, _ in pairs):
        acc = start
        for before, after in pairs:
            if acc == before:
                acc = after
        final[start] = acc
    return final


def s_replace_exact(x: str, pairs) -> str:                # R4, one literal-map lookup
    mapping = [(k, v) for k, v in exact_chain(list(pairs)).items() if k != v]
    if not mapping:
        return s_blank(x)
    v = s_blank(x)
    return f"coalesce(element_at({_lit_map(mapping)}, {v}), {v})"


def s_ascii_full_to_half(x: str) -> str:                  # R5
    return f"translate({x}, {q(_FULLWIDTH_ASCII)}, {q(_HALFWIDTH_ASCII)})"


def s_kana_half_to_full(x: str) -> str:                   # R6
    # Two-character keys are a base character and a (semi-)voicing mark. Only texts
    # that hold a mark go through the pair replaces (no two pairs overlap, so their
    # order does not matter); then one translate does the single characters, whose
    # results are never keys again.
    text = s_blank(x)
    voiced = text
    for pair, full in _KANA_PAIRS:
        voiced = f"replace({voiced}, {q(pair)}, {q(full)})"
    out = f"CASE WHEN {text} RLIKE {q('[' + _MARKS + ']')} THEN {voiced} ELSE {text} END"
    out = f"translate({out}, {q(_KANA_SINGLE_FROM)}, {q(_KANA_SINGLE_TO)})"
    return f"translate({out}, {q(_SMALL_FROM)}, {q(_SMALL_TO)})"


def s_hiragana_to_katakana(x: str) -> str:                # R7
    return f"translate({x}, {q(_HIRAGANA)}, {q(_KATAKANA)})"


def s_clean_text(x: str, conf: Conf) -> str:
    """R1, R5, R6 and hyphen look-alikes: the common core of R10, R12, R14."""
    out = s_kana_half_to_full(s_ascii_full_to_half(s_remove_spaces(x)))
    return s_replace_partial(out, conf.replaces_of(fixed.REPLACE_TO_HYPHEN))


def s_mail(x: str) -> str:                                # R13
    return f"lower({s_remove_spaces(x)})"


def s_starts_with_any(x: str, prefixes) -> str:
    prefixes = list(dict.fromkeys(prefixes))
    return _or([f"startswith({x}, {q(p)})" for p in prefixes])


def personal_phone_prefixes(conf: Conf) -> tuple:
    return tuple(re.sub(r"\D", "", k) for k in conf.keywords_of(fixed.KEYWORD_PERSONAL_PHONE))


def company_mail_prefixes(conf: Conf) -> tuple:
    return tuple(re.sub("[" + fixed.SPACES + "]", "", k).lower()
                 for k in conf.keywords_of(fixed.KEYWORD_COMPANY_EMAIL))


def s_extract_prefecture(x: str) -> str:                  # R19
    return f"coalesce(regexp_extract({x}, {q(fixed.PREFECTURE_PATTERN)}, 0), '')"


# ---- public rules: Columns ------------------------------------------------------
def remove_spaces(c) -> Column:                           # R1
    return F.expr(s_remove_spaces(sql(c)))


def digits_only(c) -> Column:                             # R2 / R11
    return F.expr(s_digits(sql(c)))


def replace_partial(c, pairs) -> Column:                  # R3
    return F.expr(s_replace_partial(sql(c), pairs))


def replace_exact(c, pairs) -> Column:                    # R4
    return F.expr(s_replace_exact(sql(c), pairs))


def ascii_full_to_half(c) -> Column:                      # R5
    return F.expr(s_ascii_full_to_half(sql(c)))


def kana_half_to_full(c) -> Column:                       # R6
    return F.expr(s_kana_half_to_full(sql(c)))


def hiragana_to_katakana(c) -> Column:                    # R7
    return F.expr(s_hiragana_to_katakana(sql(c)))


def person_name(c) -> Column:                             # R8
    return F.expr(s_kana_half_to_full(s_remove_spaces(sql(c))))


def person_kana(c) -> Column:                             # R9
    return F.expr(s_hiragana_to_katakana(s_kana_half_to_full(s_remove_spaces(sql(c)))))


def company_name(c, conf: Conf) -> Column:                # R10
    return F.expr(s_replace_partial(s_clean_text(sql(c), conf), conf.replaces_of(fixed.REPLACE_COMPANY_NAME)))


def address(c, conf: Conf) -> Column:                     # R12
    out = f"regexp_replace({s_clean_text(sql(c), conf)}, {q(_UNIT_PATTERN)}, '$1-')"
    # a hyphen not followed by a digit goes (this also leaves no trailing one)
    return F.expr(f"regexp_replace({out}, {q('-(?=' + NON_DIGIT + '|$)')}, '')")


def mail(c) -> Column:                                    # R13
    return F.expr(s_mail(sql(c)))


def department(c, conf: Conf) -> Column:                  # R14
    return F.expr(s_clean_text(sql(c), conf))


def job_post(c, conf: Conf) -> Column:                    # R15: "" -> "-", then the exact map
    pairs = [("", fixed.NO_JOB_POST)] + list(conf.replaces_of(fixed.REPLACE_NO_JOB_POST))
    return F.expr(s_replace_exact(s_clean_text(sql(c), conf), pairs))


def _when_prefix(x: str, prefixes, then_value: str, else_value: str) -> Column:
    return F.expr(f"CASE WHEN coalesce({s_starts_with_any(x, prefixes)}, false) "
                  f"THEN {then_value} ELSE {else_value} END")


def personal_phone(c, conf: Conf) -> Column:              # R16 (on a digits-only phone)
    return _when_prefix(sql(c), personal_phone_prefixes(conf), sql(c), "''")


def company_phone(c, conf: Conf) -> Column:
    return _when_prefix(sql(c), personal_phone_prefixes(conf), "''", sql(c))


def company_mail(c, conf: Conf) -> Column:                # R17 (on a standardised mail)
    return _when_prefix(sql(c), company_mail_prefixes(conf), sql(c), "''")


def personal_mail(c, conf: Conf) -> Column:
    return _when_prefix(sql(c), company_mail_prefixes(conf), "''", sql(c))


# A "postal code + address" text, split in three steps so the cleaned
# text is computed once: postal_text -> (postal_part, after_postal)
def postal_text(c, conf: Conf) -> Column:
    s = s_replace_partial(s_remove_spaces(sql(c)), conf.replaces_of(fixed.REPLACE_TO_HYPHEN))
    return F.expr(f"regexp_replace({s}, {q('^' + fixed.POSTAL_MARK + '+')}, '')")


def postal_part(text) -> Column:
    return F.expr(f"regexp_replace(regexp_extract({sql(text)}, {q('^(' + _POSTAL_PATTERN + ')')}, 1), "
                  f"{q(NON_DIGIT)}, '')")


def after_postal(text) -> Column:
    return F.expr(f"regexp_replace({sql(text)}, {q('^' + _POSTAL_PATTERN)}, '')")


def extract_prefecture(c) -> Column:                      # R19
    return F.expr(s_extract_prefecture(sql(c)))


def prefecture_code(name, conf: Conf) -> Column:          # B7: literal map lookup, no join
    mapping = dict((n, code) for code, n in conf.prefectures)
    if not mapping:
        return F.lit(None).cast("string")
    return F.expr(f"element_at({_lit_map(mapping.items())}, {sql(name)})")


def concat_blank(*cols) -> Sql:
    """Concatenation where a missing part counts as empty (never null)."""
    return Sql("concat(" + ", ".join(s_blank(sql(c)) for c in cols) + ")")


def concat_strict(*cols) -> Sql:
    """Concatenation that is null when any part is null."""
    return Sql("concat(" + ", ".join(sql(c) for c in cols) + ")")
