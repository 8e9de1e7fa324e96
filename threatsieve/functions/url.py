"""URL parsing and lexical features as native column expressions.

The accepted syntax is that of ``java.net.URL``, not of ``parse_url`` (which follows
``java.net.URI`` and rejects underscores and blanks). Whether a URL is accepted is a single
pattern over it, so a filter on it can be pushed below the projections without growing.

Accepted schemes are http, https, ftp, file, mailto and jar; others that an installation may add,
nested ``jar:`` URLs and ports in non-ASCII digits count as malformed here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatsieve.functions import constants as C

LEXICAL_FEATURES = (
    "port", "domainNameLevels", "isIP", "urllen", "longTermCount", "isDing",
    "is_Prefix_sensitive", "ishaschn", "execfile_len", "Numricinlength",
)

_TRIMMED = "".join(chr(c) for c in range(0x21))
_BLANKS = r"[\x00-\x20]*+"
_SCHEMED = r"(?i:https?|ftp|file):"
_JAR = r"(?i:jar:)"

# The patterns use possessive quantifiers: the parser scans from left to right and never goes
# back, and a possessive class neither backtracks nor recurses on long texts.
_USER = r"(?:[^/?#@]*+@)?+"
_AUTHORITY = rf"^(?i:url:)?{_SCHEMED}//(?!//){_USER}"
_SCHEME = r"^(?i:url:)?([A-Za-z][A-Za-z0-9+.\-]*+):"
_HOST_PORT = _AUTHORITY + r"([^/?#@]++)(?=[/?#]|\z)"

_HEX = r"0*[0-9A-Fa-f]{1,4}"
_OCTET = r"0*(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_QUAD = rf"(?=[0-9.]{{7,15}}[%\]]){_OCTET}(?:\.{_OCTET}){{3}}"
_IPV6 = (
    r"(?:"
    rf"(?:{_HEX}:){{7}}{_HEX}"
    rf"|(?:{_HEX}:){{6}}{_QUAD}"
    rf"|(?!(?::*+[0-9A-Fa-f]++){{8}})(?:{_HEX}(?::{_HEX})*+)?::(?:{_HEX}(?::{_HEX})*+)?(?=[%\]])"
    rf"|(?!(?::*+[0-9A-Fa-f]++:++){{6}})(?:{_HEX}(?::{_HEX})*+)?::(?:{_HEX}:)*+{_QUAD}"
    r")"
)


# Whether a dotted quad is found somewhere needs no more than one digit on either side of the two
# full middle numbers, and no groups; the same for the length of all number matches.
_MIDDLE = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HAS_QUAD = rf"\d\.{_MIDDLE}\.{_MIDDLE}\.\d"
_NUMBERS = "-?[0-9]+.[0-9]+|-?[0-9]+"


def _digits_up_to(bound: int) -> str:
    """Pattern of the whole numbers from 0 to ``bound``, leading zeros allowed."""
    text = str(bound)
    longest = [
        f"{text[:i]}[0-{int(d) - 1}]\\d{{{len(text) - i - 1}}}"
        for i, d in enumerate(text)
        if d != "0"
    ]
    return f"0*(?:\\d{{1,{len(text) - 1}}}|{'|'.join(longest)}|{text})(?!\\d)"


def _accepted(end: str, rest: str, usable_host: bool) -> str:
    """Pattern of an accepted URL text whose authority stops at ``end``, followed by ``rest``.

    ``usable_host`` also turns away hosts made of dots only, which have no label to look at.
    """
    port = rf"(?::(?:\+?{_digits_up_to(2**31 - 1)}|-0*[01])?+)?+{end}"
    dots = rf"(?!\.++(?::|{end}))" if usable_host else ""
    printable, any_char = r"[^:/?#@\x00-\x1f\x7f]*+", r"[^:/?#@]*+"
    printable_zone, any_zone = r"(?:%[^\]/?#@\x00-\x1f\x7f]++)?", r"(?:%[^\]/?#@]++)?"
    return (
        rf"(?:{_SCHEMED}(?:(?!//)|////|//[^/?#@]*+@[^/?#@]*+@)"
        rf"|(?i:https?|file)://(?!//){_USER}{dots}"
        rf"(?:\[{_IPV6}{printable_zone}\]|(?!\[){printable}){port}"
        rf"|(?i:ftp)://(?!//){_USER}{dots}(?:\[{_IPV6}{any_zone}\]|(?!\[){any_char}){port}"
        rf"|(?i:mailto):[^#]*?[^\s#]{rest})"
    )


def _pattern(usable_host: bool) -> str:
    at_text_end = rf"(?=[/?#]|{_BLANKS}\z)"
    at_bang = rf"(?=[/?]|{_BLANKS}!/(?![^#]*!/))"
    return (
        rf"^(?:{_BLANKS}(?i:url:)?{_accepted(at_text_end, '', usable_host)}"
        rf"|{_JAR}(?=[^#]*!/){_BLANKS}(?i:url:)?{_accepted(at_bang, '(?=[^#]*!/)', False)})"
    )


_PARSES = _pattern(usable_host=False)
_VALID = _pattern(usable_host=True)


def with_default_scheme(raw: Column) -> Column:
    """Put ``http://`` in front of a URL that has no ``://`` anywhere."""
    return F.when(F.contains(raw, F.lit("://")), raw).otherwise(F.concat(F.lit("http://"), raw))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units; the encoding is only paid for text that is not plain ASCII.

    Broken UTF-8, which logs do hold, counts as replacement characters instead of failing the task.
    """
    units = (F.octet_length(F.encode(F.make_valid_utf8(text), "UTF-16BE")) / 2).cast("int")
    return F.when(F.octet_length(text) == F.char_length(text), F.char_length(text)).otherwise(units)


def ends_with_any(text: Column, suffixes: Sequence[str]) -> Column:
    """True when the text ends with one of the suffixes; stays pushable as StringEndsWith."""
    found = text.endswith(suffixes[0])
    for suffix in suffixes[1:]:
        found = found | text.endswith(suffix)
    return found


def parses(url: Column) -> Column:
    """Whether the URL has an accepted syntax."""
    return url.rlike(_PARSES)


def url_parts(df: DataFrame, column: str) -> DataFrame:
    """Append ``parses``, ``scheme``, ``host`` and ``port_number`` (-1 = none given).

    The parts mean something only where ``parses`` holds.
    """
    spec = F.col(column)
    is_jar = F.lower(F.substring(spec, 1, 4)) == "jar:"
    df = df.select("*", is_jar.alias("_jar"), F.btrim(spec, F.lit(_TRIMMED)).alias("_spec"))
    spec, both, host = F.col("_spec"), F.col("_host_port"), F.col("host")
    found = F.when(F.col("_jar"), F.lit("")).otherwise(F.regexp_extract(spec, _HOST_PORT, 1))
    df = df.select("*", found.alias("_host_port"))
    bracketed = F.concat(F.substring_index(both, "]", 1), F.lit("]"))
    df = df.select(
        "*",
        parses(F.col(column)).alias("parses"),
        F.lower(F.regexp_extract(spec, _SCHEME, 1)).alias("scheme"),
        F.when(both.startswith("["), bracketed)
        .otherwise(F.substring_index(both, ":", 1))
        .alias("host"),
    )
    port = F.substring(both, F.char_length(host) + 2, F.lit(2**31 - 1))
    number = F.when(port == "", F.lit(-1)).otherwise(port.try_cast("int"))
    return df.select("*", number.alias("port_number")).drop("_jar", "_spec", "_host_port")


def lexical_columns(
    df: DataFrame, column: str = "url", tlds: Sequence[str] | None = None
) -> DataFrame:
    """Append ``full_url``, ``valid`` and the ten lexical features; no row is dropped here."""
    kept = df.columns
    df = df.select("*", with_default_scheme(F.col(column)).alias("full_url"))
    df = url_parts(df, "full_url")
    url, host = F.col("full_url"), F.col("host")
    df = df.select(
        *kept,
        "full_url",
        "port_number",
        url.rlike(_VALID).alias("valid"),
        F.rtrim(host, F.lit(".")).alias("_labels"),
        F.substring_index(F.rtrim(url, F.lit("/")), "/", -1).alias("_file"),
    )
    labels, file = F.col("_labels"), F.col("_file")
    terms = [F.contains(url, F.lit(term)).cast("int") for term in C.SENSITIVE_TERMS]
    term_count = terms[0]
    for term in terms[1:]:
        term_count = term_count + term
    return df.select(
        *kept,
        "full_url",
        "valid",
        F.when(F.col("port_number") == -1, F.lit(80)).otherwise(F.col("port_number")).alias("port"),
        (F.char_length(labels) - F.char_length(F.replace(labels, F.lit("."))) + 1)
        .alias("domainNameLevels"),
        url.rlike(_HAS_QUAD).alias("isIP"),
        utf16_length(url).alias("urllen"),
        term_count.alias("longTermCount"),
        F.substring_index(labels, ".", -1)
        .isin(list(C.KNOWN_TLDS if tlds is None else tlds))
        .alias("isDing"),
        ends_with_any(url, C.SENSITIVE_SUFFIXES).alias("is_Prefix_sensitive"),
        file.rlike(C.CHINESE_PATTERN).alias("ishaschn"),
        utf16_length(file).alias("execfile_len"),
        (utf16_length(file) - utf16_length(F.regexp_replace(file, _NUMBERS, "")))
        .alias("Numricinlength"),
    )


def lexical_features(
    df: DataFrame,
    column: str = "url",
    keep: Sequence[str] = (),
    tlds: Sequence[str] | None = None,
) -> DataFrame:
    """The lexical feature rows; URLs that cannot be parsed are left out."""
    needed = df.select(*keep, F.col(column).alias("_raw"))
    featured = lexical_columns(needed, "_raw", tlds)
    return featured.where("valid").select(
        *keep, F.col("full_url").alias("Url"), *LEXICAL_FEATURES
    )
