"""Text rules as native column expressions."""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space, a word character and a line end in Python
# strings, written as the inside of a Java character class.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
LINE_END = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85\x{2028}\x{2029}]"

# Fixed value: a canonical UUID.
UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"

# The redaction rule.
SECRET_WORDS = r"password|api_key|token"
SECRET_MASK = "[REDACTED]"
SECRET_VARIABLE = re.compile(r"KEY|TOKEN|SECRET|PASSWORD|DSN|CREDENTIAL", re.IGNORECASE)
SHORTEST_SECRET = 5

# Media types by file suffix.
MEDIA_TYPES = {
    ".avif": "image/avif",
    ".bmp": "image/bmp",
    ".css": "text/css",
    ".csv": "text/csv",
    ".doc": "application/msword",
    ".gif": "image/gif",
    ".htm": "text/html",
    ".html": "text/html",
    ".jpeg": "image/jpeg",
    ".jpg": "image/jpeg",
    ".js": "text/javascript",
    ".json": "application/json",
    ".md": "text/markdown",
    ".mp3": "audio/mpeg",
    ".mp4": "video/mp4",
    ".parquet": "application/vnd.apache.parquet",
    ".pdf": "application/pdf",
    ".png": "image/png",
    ".ppt": "application/vnd.ms-powerpoint",
    ".py": "text/x-python",
    ".svg": "image/svg+xml",
    ".tar": "application/x-tar",
    ".tif": "image/tiff",
    ".tiff": "image/tiff",
    ".tsv": "text/tab-separated-values",
    ".txt": "text/plain",
    ".wav": "audio/x-wav",
    ".webm": "video/webm",
    ".webp": "image/webp",
    ".xls": "application/vnd.ms-excel",
    ".xml": "text/xml",
    ".zip": "application/zip",
}
OTHER_MEDIA = "application/octet-stream"

# One observation line: item, a separator, a number, then perhaps a comma and a category.
# Possessive runs keep the match linear on long lines; the second head alternative is the
# blank item, which the grammar allows.
_HEAD = (
    rf"(?:[{SPACE}]*+([{WORD}-](?:[{WORD}-]++| ++(?=[{WORD}-]))*+)[{SPACE}]*+"
    rf"|[{SPACE}&&[^ ]]*+ [{SPACE}]*+)"
)
_NUMBER = r"(-?\p{Nd}++(?:\.\p{Nd}++)?+)"
OBSERVATION_LINE = (
    rf"\A{_HEAD}[,：:][{SPACE}]*+{_NUMBER}[{SPACE}]*+(?:,[{SPACE}]*+(.*))?\z"
)


@lru_cache(maxsize=1)
def _digit_tables() -> tuple[str, str]:
    """Every decimal digit of every script, and the ASCII digit it stands for."""
    digits = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.digit(c)) for c in digits)


def lines(text: Column) -> Column:
    return F.split(text, LINE_END)


def cut_observation(line: Column) -> Column:
    """Item, number and category with NUL between them; the line itself when it is no observation.

    One pass of the expression tells whether the line matches (the result differs) and gives
    all three parts.
    """
    return F.regexp_replace(line, OBSERVATION_LINE, "$1\0$2\0$3")


def observation_parts(cut: Column) -> tuple[Column, Column, Column]:
    parts = F.split(cut, "\0", 3)
    number = parts[1]
    foreign, ascii_digits = _digit_tables()
    value = F.when(number.rlike(r"\A[-.0-9]+\z"), number).otherwise(F.translate(number, foreign, ascii_digits))
    return parts[0], value.cast("double"), blank_to_null(parts[2])


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def number_or_null(text: Column) -> Column:
    """Blank is null; anything else must be a number or the job fails."""
    return blank_to_null(text).cast("double")


# How a number may be written in Python source, blanks around it allowed.
_DIGITS = r"\p{Nd}+(?:_\p{Nd}+)*"
SIMPLE_FLOAT = r"\A-?[0-9]{1,15}(?:\.[0-9]{1,15})?\z"
FLOAT = rf"(?i)\A[{SPACE}]*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?(?:e[+-]?{_DIGITS})?|\.{_DIGITS}(?:e[+-]?{_DIGITS})?|inf(?:inity)?|nan)[{SPACE}]*\z"


def float_or_null(text: Column) -> Column:
    """Blank is null; a number may have underscores between digits and any script's digits; else the job fails."""
    foreign, ascii_digits = _digit_tables()
    bare = F.regexp_replace(text, rf"[{SPACE}_]", "")
    number = F.when(bare.rlike(r"[^\x00-\x7f]"), F.translate(bare, foreign, ascii_digits)).otherwise(bare).cast("double")
    wrong = F.raise_error(F.concat(F.lit("could not convert string to float: "), text)).cast("double")
    # The usual form needs none of the rewriting.
    return F.when(text.isNull() | (text == ""), None).when(text.rlike(SIMPLE_FLOAT), text.cast("double")).when(text.rlike(FLOAT), number).otherwise(wrong)


# The short escapes of JSON strings.
JSON_ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def json_string(text: Column) -> Column:
    """A JSON string with lower-case escapes of other control characters."""
    short = text
    for char, escape in JSON_ESCAPES.items():
        short = F.replace(short, F.lit(char), F.lit(escape))
    full = short
    for code in range(32):
        if chr(code) not in JSON_ESCAPES:
            full = F.replace(full, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    special = text.rlike(r'[\x00-\x1f"\\]')
    rare = text.rlike(r"[\x00-\x07\x0b\x0e-\x1f]")
    return F.concat(F.lit('"'), F.when(~special, text).when(rare, full).otherwise(short), F.lit('"'))


def strip_bom(text: Column) -> Column:
    return F.regexp_replace(text, r"^\x{FEFF}", "")


def utf8_text(content: Column) -> Column:
    return strip_bom(F.decode(content, "UTF-8"))


def file_text(content: Column) -> Column:
    """Text of a file as it is read in text mode: UTF-8, no byte order mark, line ends as newlines."""
    return F.regexp_replace(utf8_text(content), r"\r\n?", "\n")


def known_secrets(variables: dict[str, str] | None = None) -> list[str]:
    """Values of secret-looking variables that are long enough to be searched for."""
    variables = os.environ if variables is None else variables
    return [
        value
        for name, value in variables.items()
        if len(value) >= SHORTEST_SECRET and SECRET_VARIABLE.search(name)
    ]


def redact(text: Column, secrets: list[str] | tuple[str, ...] = ()) -> Column:
    """Hide known secret strings, then every `name = value` whose name ends in a secret word."""
    for secret in secrets:
        text = F.replace(text, F.lit(secret), F.lit(SECRET_MASK))
    pattern = rf"(?iu)({SECRET_WORDS})[{SPACE}]*+=[{SPACE}]*+[^{SPACE};&]+"
    return F.regexp_replace(text, pattern, "$1=[REDACTED]")


def redact_text(value: str, secrets: list[str] | tuple[str, ...] = ()) -> str:
    """The same rule for a short text on the driver, such as a statement that is logged."""
    for secret in secrets:
        value = value.replace(secret, SECRET_MASK)
    return re.sub(rf"(?i)({SECRET_WORDS})\s*=\s*[^\s;&]+", rf"\1={SECRET_MASK}", value)


def strip_fence(text: Column) -> Column:
    """Remove the Markdown fence a model puts round its JSON."""
    trimmed = F.regexp_replace(text, rf"\A[{SPACE}]+|(?<![{SPACE}])[{SPACE}]++\z", "")
    return F.regexp_replace(
        trimmed, rf"\A```(?:json)?[{SPACE}]*+|(?<![{SPACE}])[{SPACE}]*+```\z", ""
    )


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=[^.])\.[^.]*$", "")


def file_suffix(path: Column) -> Column:
    """The last suffix in lower case; names that only start with dots have none."""
    bare = F.regexp_replace(file_name(path), r"^\.+", "")
    return F.lower(F.regexp_extract(bare, r"(\.[^.]*)$", 1))


def media_type(path: Column) -> Column:
    """Media type from the suffix, looking through a compression suffix."""
    plain = F.regexp_replace(file_name(path), r"(?i)\.(gz|bz2|xz|br|z)$", "")
    plain = F.regexp_replace(plain, r"(?i)\.(tgz|taz|tz|tbz2|txz)$", ".tar")
    table = F.create_map(*[F.lit(x) for pair in MEDIA_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, file_suffix(plain)), F.lit(OTHER_MEDIA))


def data_url(content: Column, mime: Column) -> Column:
    """A data URL on one line, also where the session's base64 breaks lines."""
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.translate(F.base64(content), "\r\n", ""))


def marker_pattern(label: str) -> str:
    """A labelled canonical UUID that is not part of a longer word."""
    return rf"(?i)(?<![A-Za-z0-9_]){re.escape(label)}:({UUID})(?![A-Za-z0-9_])"


def marker_ids(text: Column, label: str) -> Column:
    return F.regexp_extract_all(text, F.lit(marker_pattern(label)), 1)
