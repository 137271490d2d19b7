"""String, date, path and identifier functions on Spark columns."""

from __future__ import annotations

import html as _html
import json
import re
import unicodedata
from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import cache, reduce
from html import entities as _entities
from operator import or_
from re import _parser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quire import values as V

# Characters Python treats as blank; Java's \s and Spark's trim know only some of them.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(code) for code in range(0x2000, 0x200B)
)
BLANK_RUN = "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"
# One line with its terminator, for every terminator Python's splitlines knows.
_BREAKS = "\\n\\r\\x0B\\f\\x1C\\x1D\\x1E\\x85\\u2028\\u2029"
LINE_BREAK = f"[{_BREAKS}]"
# What is taken is not given back: the last line, which has no terminator, is gone through once.
LINE_WITH_BREAK = f"[^{_BREAKS}]++(?:\\r\\n|[{_BREAKS}])?+|\\r\\n|[{_BREAKS}]"
# Decimal digits plus the superscript, subscript and enclosed digits Python also calls digits.
DIGIT = (
    "[\\p{Nd}\\u00b2\\u00b3\\u00b9\\u2070\\u2074-\\u2079\\u2080-\\u2089\\u2460-\\u2468"
    "\\u2474-\\u247c\\u2488-\\u2490\\u24ea\\u24f5-\\u24fd\\u24ff\\u2776-\\u277e"
    "\\u2780-\\u2788\\u278a-\\u2792]"
)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def computed_once(value: Column) -> Column:
    """``value`` as a generated column: a filter on it is not pushed below, where it would be worked
    out a second time."""
    return F.explode(F.array(value))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def collapse_blanks(col: Column) -> Column:
    return strip(F.regexp_replace(col, BLANK_RUN, " "))


def fold_one(value: str) -> str:
    """The folding rule for one string; the tables below and the exact form are built from it."""
    mapped = value.translate({ord("đ"): "d", ord("Đ"): "d", ord("Ð"): "d"}).casefold()
    bare = "".join(c for c in unicodedata.normalize("NFKD", mapped) if not unicodedata.combining(c))
    return bare.translate({ord(c): " " for c in "_-."})


@cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Per-character folding of the basic plane: one-to-one and deleted, and one-to-many."""
    source, target, dropped, many = [], [], [], {}
    for code in range(1, 0x10000):
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3:
            continue  # surrogates; Hangul syllables have no Latin folding
        char = chr(code)
        folded = fold_one(char)
        if folded == char:
            continue
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        elif not folded:
            dropped.append(char)
        else:
            many[char] = folded
    return "".join(source) + "".join(dropped), "".join(target), many


@cache
def _many_class(gap: int) -> str:
    """Regex class of the one-to-many characters; spans nearer than ``gap`` are merged.

    The merged class is short and so quick to test. The Latin letters of U+0100 to U+0250 and the
    Vietnamese ones of U+1EA0 to U+1EFF are never swallowed by a merge.
    """
    codes = sorted(map(ord, _fold_tables()[2]))
    spans: list[list[int]] = []
    for code in codes:
        keep_apart = code < 0x250 or (spans and spans[-1][1] < 0x1EA0 <= code)
        if spans and code - spans[-1][1] <= (1 if keep_apart else gap):
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"\\u{low:04x}-\\u{high:04x}" for low, high in spans) + "]"


def fold_text(col: Column) -> Column:
    """Lower case without diacritics, with ``_ - .`` as blanks; stays inside the JVM.

    ASCII text takes the short branch. Other text goes through one ``translate``; characters that
    fold to several letters (ß, ligatures, fractions …) are then expanded, only where present.
    Hangul syllables and characters beyond the basic plane are left as they are: `fold_text_exact`
    covers them.
    """
    source, target, many = _fold_tables()
    pairs = "\x02".join(f"{char}\x01{folded}" for char, folded in many.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x01"))

    def expand(bare: Column) -> Column:
        present = F.array_distinct(F.regexp_extract_all(bare, F.lit(_many_class(1)), F.lit(0)))
        expanded = F.aggregate(
            present, bare, lambda text, char: F.replace(text, char, F.try_element_at(table, char))
        )
        return F.when(bare.rlike(_many_class(0x400)), expanded).otherwise(bare)

    return F.when(
        ~col.rlike("[^\\x00-\\x7F]"), F.lower(F.translate(col, "_-.", "   "))
    ).otherwise(bind(F.translate(col, source, target), expand))


@F.pandas_udf(StringType())
def fold_text_exact(texts: pd.Series) -> pd.Series:
    """Exact folding for any script, in Arrow batches."""
    return texts.map(fold_one, na_action="ignore")


def normalize_ticker(col: Column) -> Column:
    """Trimmed upper-case ticker; an empty one is null."""
    return F.nullif(F.upper(strip(col)), F.lit(""))


def slug_document_id(
    ticker: Column, title: Column, updated: Column, prefix: str
) -> Column:
    slug = F.btrim(F.regexp_replace(F.lower(title), "[^a-zA-Z0-9]+", "-"), F.lit("-"))
    return F.concat_ws(
        "-", F.lit(prefix), F.upper(ticker), slug, F.date_format(updated, "yyyy-MM-dd")
    )


def filename_from_download_url(url: Column) -> Column:
    """Last path segment of the percent-decoded ``url=`` parameter, else ``download.pdf``."""
    query = F.regexp_extract(url, "^[^?#]*\\?([^#]*)", 1)
    encoded = F.nullif(F.regexp_extract(query, "url=([^&]+)", 1), F.lit(""))
    # A plus sign is data here, not a blank as in form encoding.
    decoded = F.coalesce(F.try_url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))), encoded)
    path = F.regexp_extract(
        decoded, "^(?:[a-zA-Z][a-zA-Z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)", 1
    )
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), ";.*$", "")
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("download.pdf"))


def sanitize_filename(name: Column) -> Column:
    """File name safe for an object path; null where nothing is left (an error upstream)."""
    last = F.element_at(F.split(F.replace(strip(name), F.lit("\\"), F.lit("/")), "/"), -1)
    return F.nullif(F.regexp_replace(last, "[^\\p{L}\\p{N}_.\\-() ]+", "_"), F.lit(""))


def raw_object_path(sha256: Column) -> Column:
    """Path derived from content only; null for a digest shorter than eight characters."""
    sha = F.lower(strip(sha256))
    path = F.concat_ws("/", F.lit("raw_objects"), F.substring(sha, 1, 8), sha, F.lit("blob"))
    return F.when(F.length(sha) >= 8, path)


def legacy_object_path(
    ticker: Column, year: Column, source: Column, sha256: Column, filename: Column
) -> Column:
    return F.concat_ws(
        "/", F.lit("raw"), F.upper(ticker), year.cast("string"), F.lower(source), sha256,
        sanitize_filename(filename),
    )


def parse_us_date(text: Column) -> Column:
    """First M/D/YYYY date after the word 'updated', comment markers removed."""
    clean = F.replace(text, F.lit("<!-- -->"), F.lit(""))
    found = F.regexp_extract(clean, f"(?i){V.UPDATED_DATE}", 1)
    return F.to_date(F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("M/d/yyyy")))


def map_scope(title: Column) -> Column:
    lower = F.lower(title)
    return (
        F.when(lower.rlike("consolidated financial statements?\\b"), "consolidated")
        .when(lower.rlike("separate financial statements?\\b"), "standalone")
        .otherwise("unknown")
    )


def map_audit_status(title: Column, strict: bool = False) -> Column:
    """Audit status from a title.

    Parity form: the word "unaudited" contains "audited" and so maps to audited. ``strict`` tests
    "unaudited" first.
    """
    lower = F.lower(title)
    audited, unaudited = lower.contains("audited"), lower.contains("unaudited")
    if strict:
        return F.when(unaudited, "unaudited").when(audited, "audited").otherwise("unknown")
    return F.when(audited, "audited").when(unaudited, "unaudited").otherwise("unknown")


def map_document_type(title: Column) -> Column:
    return F.when(F.lower(title).contains("financial statement"), "financial_statement").otherwise(
        "other"
    )


# Entities are resolved in the JVM from the standard library's HTML5 tables.
_LONGEST_BARE = max(len(name) for name in _entities.html5 if not name.endswith(";"))
_CONTROLS = {  # numeric references that stand for something else than their number
    0x00: "\ufffd", 0x0D: "\r",
    **{code: bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(0x80, 0xA0)},
}


def _char_map(pairs: dict) -> Column:
    """A constant map; as one literal it costs the plan a line, not thousands of expressions."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _numeric_entity(part: Column) -> Column:
    """Text after '&' that starts with '#' and digits: what they stand for, then the rest."""
    decimal = F.regexp_extract(part, "^#([0-9]+);?", 1)
    hexa = F.regexp_extract(part, "^#[xX]([0-9a-fA-F]+);?", 1)
    digits = F.when(decimal != "", F.ltrim(decimal, F.lit("0"))).otherwise(F.ltrim(hexa, F.lit("0")))
    number = F.when(digits == "", F.lit(0)).when(F.length(digits) > 8, F.lit(0x7FFFFFFF)).otherwise(
        F.when(decimal != "", digits.cast("bigint")).otherwise(F.conv(digits, 16, 10).cast("bigint")))
    rest = F.regexp_replace(part, "^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", "")
    nothing = (number < 9) | (number == 11) | number.between(14, 31) | number.between(0x7F, 0x9F) | (
        number.between(0xFDD0, 0xFDEF)) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    char = (
        F.when((number > 0x10FFFF) | number.between(0xD800, 0xDFFF), "\ufffd")
        .otherwise(F.coalesce(
            F.try_element_at(_char_map(_CONTROLS), number.cast("string")),
            F.when(nothing, "").otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))))
    )
    return F.when((decimal == "") & (hexa == ""), F.concat(F.lit("&"), part)).otherwise(F.concat(char, rest))


def _named_entity(part: Column, bare_names: bool) -> Column:
    """Text after '&': a name with its semicolon, else the longest bare name that it starts with."""
    full = {name: char for name, char in _entities.html5.items() if name.endswith(";")}
    bare = {name: char for name, char in _entities.html5.items() if not name.endswith(";")}
    known = _char_map(full)
    name = F.regexp_extract(part, "^([^\t\n\f <&#;]{1,32};)", 1)
    stem = F.regexp_extract(part, "^([^\t\n\f <&#;]{1,32})", 1)
    found = F.when(name != "", F.concat(F.try_element_at(known, name), F.substring(part, F.length(name) + 1, 1 << 30)))
    table = _char_map(bare)
    shorter = [
        F.when(F.length(stem) >= n, F.concat(F.try_element_at(table, F.substring(part, 1, n)),
                                             F.substring(part, n + 1, 1 << 30)))
        for n in range(_LONGEST_BARE if bare_names else 0, 1, -1)
    ]
    return F.coalesce(found, *shorter, F.concat(F.lit("&"), part))


def html_clean(col: Column, bare_names: bool = True) -> Column:
    """Drop ``<!-- -->`` markers and unescape entities, once, as HTML5 does.

    HTML5 also reads entities without their semicolon; without ``bare_names`` these stay as they are.
    """
    text = F.replace(col, F.lit("<!-- -->"), F.lit(""))

    def resolved(part: Column) -> Column:
        char = F.when(part.startswith("#"), _numeric_entity(part)).otherwise(_named_entity(part, bare_names))
        if bare_names:
            return char
        closed = part.rlike("^(?:#[0-9]+|#[xX][0-9a-fA-F]+|[0-9A-Za-z]+);")
        return F.when(closed, char).otherwise(F.concat(F.lit("&"), part))

    unescaped = F.array_join(
        F.transform(F.split(text, "&"), lambda p, i: F.when(i == 0, p).otherwise(resolved(p))), "")
    return F.when(text.contains("&"), unescaped).otherwise(text)


@F.pandas_udf(StringType())
def html_clean_exact(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: _html.unescape(t.replace("<!-- -->", "")), na_action="ignore")


def dedupe_warnings(col: Column) -> Column:
    return F.array_distinct(col)


def clean_metadata(col: Column) -> Column:
    return F.map_filter(col, lambda _, v: v.isNotNull() & (v != ""))


def fixture_slug(filename: Column, sha256: Column) -> Column:
    """Stem of the file name reduced to safe characters, 80 at most, plus 12 digest characters."""
    last = F.element_at(F.split(F.regexp_replace(filename, "/+$", ""), "/"), -1)
    stem = F.when(last.rlike("^.+\\.[^.]+$"), F.regexp_replace(last, "\\.[^.]+$", "")).otherwise(last)
    safe = F.btrim(F.regexp_replace(stem, "[^A-Za-z0-9._-]+", "_"), F.lit("_"))
    return F.concat_ws("_", F.substring(safe, 1, 80), F.substring(sha256, 1, 12))


def _float_text(exponent_from: float) -> Callable[[Column], Column]:
    """Shortest text that reads back as the same number; Spark's own has another form."""
    def text(value: float) -> str:
        value = float(value)
        shortest = repr(value)
        if 1e16 <= abs(value) < exponent_from:
            return f"{Decimal(shortest):f}.0"
        return shortest

    @F.pandas_udf(StringType())
    def texts(values: pd.Series) -> pd.Series:
        return values.astype(object).map(lambda v: None if v is None or v != v else text(v), na_action="ignore")

    return texts


def value_text(col: Column, data_type: str, exponent_from: float = 1e16) -> Column:
    """Stable text of a sheet value by its Spark type name.

    Large floating-point numbers get an exponent as in Python, or only from a larger ``exponent_from`` on.
    """
    if data_type == "boolean":
        return F.upper(col.cast("string"))
    if data_type == "date":
        return F.date_format(col, "yyyy-MM-dd")
    if data_type.startswith("timestamp"):
        return F.regexp_replace(
            F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "\\.000000$", ""
        )
    if data_type in ("double", "float"):
        return _float_text(exponent_from)(col.cast("double"))
    if data_type == "binary":
        return F.make_valid_utf8(col.cast("string"))
    return col.cast("string")


_REPEATS = ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT")
#: What Java reads in another way than the parser used here: flags, sets in sets, \\v, \\Q and octal numbers.
_READ_OTHERWISE = re.compile(r"\(\?[A-Za-z-]+[:)]|\[[^\]]*(?:\[|&&)|\\[vQEhHRXGzk0]")


def _better(one: frozenset[str] | None, other: frozenset[str] | None) -> frozenset[str] | None:
    """The set whose shortest member is longer (signs count as rarer than letters), of equals the smaller one."""
    def rank(words: frozenset[str] | None) -> tuple:
        if words is None:
            return (-1, 0)
        return (min((len(w) + (not w.isalnum()) / 2 for w in words), default=float("inf")), -len(words))

    return max(one, other, key=rank)


def _words_of(parsed) -> frozenset[str] | None:
    """Texts of which each match of a parsed pattern within ASCII text has one; none if it has no such match."""
    best, run = None, ""
    for kind, value in [*((str(k), v) for k, v in parsed), ("END", None)]:
        if kind == "LITERAL" and value < 0x80:
            run += chr(value).lower()
            continue
        if run:
            best, run = _better(best, frozenset([run])), ""
        found = None
        if kind == "LITERAL":
            cases = {chr(value), chr(value).lower(), chr(value).upper(), chr(value).upper().lower()}
            found = None if any(c.isascii() for c in "".join(cases)) else frozenset()
        elif kind == "SUBPATTERN":
            found = _words_of(value[3])
        elif kind in _REPEATS and value[0] > 0:
            found = _words_of(value[2])
        elif kind == "BRANCH":
            parts = [_words_of(part) for part in value[1]]
            found = None if None in parts else frozenset().union(*parts)
        best = _better(best, found)
    return best


@cache
def needed_words(*patterns: str) -> tuple[str, ...] | None:
    """Lower-case texts of which ASCII text has at least one, in either case, if one of ``patterns`` is found in it.

    None if that cannot be told. Patterns may be searched for without regard to case.
    """
    words: set[str] = set()
    for pattern in patterns:
        try:
            found = None if _READ_OTHERWISE.search(pattern) else _words_of(_parser.parse(pattern))
        except (re.error, OverflowError):
            found = None
        if found is None:
            return None
        words |= found
    return tuple(sorted(w for w in words if not any(v in w for v in words - {w})))


def may_match(text: Column, *patterns: str, lower: Column | None = None) -> Column:
    """False only for text in which none of ``patterns`` is found, told without a regular expression.

    Searches for a few words are many times as fast as one for patterns that go by the rules of Unicode. Text
    beyond ASCII may always match. ``lower`` is the text in lower case, where it is known.
    """
    words = needed_words(*patterns)
    if words is None:
        return F.lit(True)
    beyond = F.octet_length(text) != F.length(text)
    lower = F.lower(text) if lower is None else lower
    return reduce(or_, (F.contains(lower, F.lit(word)) for word in words), beyond)


def extracted(text: Column, pattern: str, flags: str) -> Column:
    """First group of ``pattern`` in ``text``, empty if it is not found."""
    return F.when(may_match(text, pattern), F.regexp_extract(text, f"(?{flags}){pattern}", 1)).otherwise(
        F.when(text.isNotNull(), ""))


def first_rule(folded: Column, rules: Sequence, result: Callable[..., Column]) -> Column:
    """The first rule, in order, whose pattern is found; null without one.

    Rules are a small parameter list, so they become part of the expression: no rule table is joined
    and no (text, rule) pair is ever produced. Text without a word that some rule needs goes at once, other
    ordinary text after one test of all patterns together.
    """
    maybe = may_match(folded, *(rule.pattern for rule in rules), lower=folded)
    return F.when(maybe, first_matching(lambda pattern: folded.rlike(pattern), rules, result))


def first_matching(matches: Callable[[str], Column], rules: Sequence, result: Callable[..., Column]) -> Column:
    """The first rule that ``matches``. Patterns find either case, as rules may be written in either."""
    any_rule = "|".join(f"(?:{rule.pattern})" for rule in rules)
    ladder = F.when(~matches(f"(?iU){any_rule}"), F.lit(None))
    for rule in rules:
        ladder = ladder.when(matches(f"(?iU){rule.pattern}"), result(rule))
    return ladder
