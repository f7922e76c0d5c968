"""Column expressions for raw portal values: numbers, times, sizes, keys, hashes, JSON, spreadsheet safety.

All of them are null-safe and return null for values they cannot read, also
under ANSI mode.
"""

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PORTAL_ZONE = "Asia/Almaty"

# Russian month stems of the portals' times.
MONTHS_RU = {
    "янв": 1,
    "фев": 2,
    "мар": 3,
    "апр": 4,
    "мая": 5,
    "май": 5,
    "июн": 6,
    "июл": 7,
    "авг": 8,
    "сен": 9,
    "окт": 10,
    "ноя": 11,
    "дек": 12,
}

# Keys of log records that hold secrets.
SECRET_KEYS = ("authorization", "cookie", "cookies", "captcha_token", "proxy_password", "twocaptcha_api_key", "x-api-key")

#: extensions that exports meet, with their content types
MIME_TYPES = {
    "csv": "text/csv",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "gif": "image/gif",
    "htm": "text/html",
    "html": "text/html",
    "jpeg": "image/jpeg",
    "jpg": "image/jpeg",
    "json": "application/json",
    "pdf": "application/pdf",
    "png": "image/png",
    "rar": "application/vnd.rar",
    "rtf": "application/rtf",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "txt": "text/plain",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xml": "text/xml",
    "zip": "application/zip",
}


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def clean_text(c: Column) -> Column:
    """White space of any kind, no-break spaces included, collapsed; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(c, r"(?U)[\s ]+", " ")), F.lit(""))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def parse_decimal(c: Column, kind: str = "decimal(24,6)") -> Column:
    """A number with grouping and a decimal point or comma; with both, the comma is the decimal sign."""

    def read(kept: Column) -> Column:
        comma, point = F.contains(kept, F.lit(",")), F.contains(kept, F.lit("."))
        plain = F.when(comma & point, F.translate(kept, ".,", "\0.")).otherwise(F.translate(kept, ",", "."))
        return F.replace(plain, F.lit("\0"), F.lit("")).try_cast(kind)

    return bound(F.regexp_replace(c, r"(?U)[^\d,.\-]", ""), read)


def lenient_decimal(c: Column, kind: str = "decimal(24,6)") -> Column:
    """A number whose spaces are dropped and whose comma is a decimal sign."""
    return F.translate(F.translate(c, " ", ""), ",", ".").try_cast(kind)


def ambiguous_decimal(c: Column) -> Column:
    """Numbers such as 1,234.56, whose comma may have been meant for grouping."""
    return c.rlike(r"^[^.]*,[^.]*\.[^,]*$")


def in_zone(naive: Column, zone: str = PORTAL_ZONE) -> Column:
    """The instant of a wall-clock time."""
    return F.to_utc_timestamp(naive, zone) if zone != "UTC" else naive


def parse_portal_time(c: Column, zone: str = PORTAL_ZONE) -> Column:
    """ISO-like times, or day, Russian month, year and time anywhere in a text; portal wall clock."""
    iso = r"(\d{4}-\d{2}-\d{2})[ T](\d{2}:\d{2}:\d{2})"
    named = r"(\d{1,2})\s+([а-яё]{3})[а-яё.]*\s+(\d{4}).*?(\d{2}:\d{2}:\d{2})"
    low = F.lower(c)
    months = F.create_map(*[F.lit(x) for pair in MONTHS_RU.items() for x in pair])
    month = F.try_element_at(months, F.regexp_extract(low, named, 2))
    spelled = F.concat(F.regexp_extract(low, named, 3), F.lit("-"), month.cast("string"), F.lit("-"), F.regexp_extract(low, named, 1), F.lit(" "), F.regexp_extract(low, named, 4))
    first = F.try_to_timestamp(F.concat_ws(" ", F.regexp_extract(c, iso, 1), F.regexp_extract(c, iso, 2)), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.when(c.rlike(iso), in_zone(first, zone)).otherwise(in_zone(F.try_to_timestamp(spelled, F.lit("yyyy-M-d HH:mm:ss")), zone))


def parse_iso_time(c: Column, zone: str = PORTAL_ZONE) -> Column:
    """ISO time with an offset or Z; without one, portal wall clock."""
    offset = c.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & c.rlike(r"[T ]\d{2}:\d{2}")
    instant = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), c).try_cast("timestamp")
    return F.when(offset, instant).otherwise(in_zone(instant, zone))


def local_time(c: Column, zone: str = PORTAL_ZONE) -> Column:
    """Wall-clock time of an instant (UTC) in a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), c.cast("timestamp_ntz"))


def parse_size(c: Column) -> Column:
    """'64,813 КБ' in bytes, cut to whole bytes."""
    low = F.lower(c)
    unit = F.when(low.rlike("кб|kb"), 1024).when(low.rlike("мб|mb"), 1024**2).when(low.rlike("гб|gb"), 1024**3).otherwise(1)
    return F.floor(parse_decimal(c) * unit.cast("decimal(11,0)")).cast("long")


def stable_key(source: Column, entity_type: Column, entity_id: Column) -> Column:
    return F.concat_ws(":", source, entity_type, entity_id)


def content_hash(*columns: Column, separator: str = "\x1f") -> Column:
    """SHA-256 over a declared list of columns in the order given; null differs from the empty text."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("!")) for c in columns]
    return F.sha2(F.concat_ws(separator, *parts), 256)


def canonical_json(mapping: Column) -> Column:
    """JSON of a map with keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(mapping))))


def document_key(document_id: Column, file_hash: Column, url: Column, filename: Column, row: Column) -> Column:
    """Identity of a document of an owner: id, else hash, address, name, or a hash of the row; 512 characters at most."""
    return F.left(F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in (document_id, file_hash, url, filename)], F.sha2(row, 256)), F.lit(512))


def file_extension(name: Column) -> Column:
    """Lower-case last suffix; none for dot-files."""
    base = F.regexp_extract(name, r"([^/\\]*)$", 1)
    return F.nullif(F.lower(F.regexp_extract(base, r"[^.].*\.([^.]+)$|^[^.]\.([^.]+)$", 1)), F.lit(""))


def mime_type(name: Column) -> Column:
    kinds = F.create_map(*[F.lit(x) for pair in MIME_TYPES.items() for x in pair])
    return F.try_element_at(kinds, F.coalesce(file_extension(name), F.lit("")))


def is_formula(c: Column) -> Column:
    """Whether a spreadsheet would run the cell; plain negative numbers are no formulas."""
    trimmed = F.regexp_replace(c, r"^[ \t\r\n]+", "")
    return F.coalesce(trimmed.rlike(r"^[=+@]") | (trimmed.rlike("^-") & ~trimmed.rlike(r"^-\d+([.,]\d+)?$")), F.lit(False))


def escape_formula(c: Column) -> Column:
    return F.when(is_formula(c), F.concat(F.lit("'"), c)).otherwise(c)


def json_text(payload: Column, path: str) -> Column:
    return F.get_json_object(payload, path)


def json_contains(payload: Column, expected: dict[str, str]) -> Column:
    """Whether all given paths hold the given texts."""
    out = F.lit(True)
    for path, value in expected.items():
        out = out & F.get_json_object(payload, path).eqNullSafe(F.lit(value))
    return out


def merge_json(old: Column, new: Column) -> Column:
    """Shallow merge of two JSON objects, keys in order; the right one wins. Values keep their types and digits."""
    a, b = (F.from_json(F.coalesce(c, F.lit("{}")), "map<string,variant>") for c in (old, new))
    merged = F.map_concat(F.map_filter(a, lambda k, _: ~F.array_contains(F.map_keys(b), k)), b)
    names = F.array_sort(F.map_keys(merged))
    return F.to_json(F.map_from_arrays(names, F.transform(names, lambda k: F.try_element_at(merged, k))))


_JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s"{}\[\],:]+|\s+|"', re.S)


def redact_text(line: str, keys: frozenset[str]) -> str:
    """A line of JSON with the values of secret keys replaced, whatever their depth and form; all else stays byte for byte."""
    out, tokens, i = [], _JSON_TOKEN.findall(line), 0
    while i < len(tokens):
        name = tokens[i]
        out.append(name)
        i += 1
        colon = i
        while colon < len(tokens) and tokens[colon].isspace():
            colon += 1
        if name[0] != '"' or colon == len(tokens) or tokens[colon] != ":" or _unquoted(name).lower() not in keys:
            continue
        value = colon + 1
        while value < len(tokens) and tokens[value].isspace():
            value += 1
        out += [*tokens[i:value], '"[REDACTED]"']
        i, depth = value, 0
        while i < len(tokens):  # past the value
            token = tokens[i]
            if depth == 0 and token in ("}", "]", ","):
                break
            depth += (token in ("{", "[")) - (token in ("}", "]"))
            i += 1
            if depth == 0 and not token.isspace():
                break
    return "".join(out)


def _unquoted(name: str) -> str:
    try:
        return json.loads(name) if "\\" in name else name[1:-1]
    except ValueError:
        return name[1:-1]


def redact(payload: Column, keys: tuple[str, ...] = SECRET_KEYS) -> Column:
    """Values of secret keys, at any depth and in any case, replaced; a value may be a scalar, a list or an object of any depth."""
    names = frozenset(k.lower() for k in keys)

    @F.pandas_udf("string")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda x: redact_text(x, names), na_action="ignore")

    return run(payload)


def duration_parts(seconds: Column) -> Column:
    return F.when(seconds.isNotNull(), F.struct(F.round(seconds, 2).alias("seconds"), F.round(seconds / 3600, 2).alias("hours"), F.round(seconds / 86400, 2).alias("days")))


def retry_delay(attempt: Column, most: int = 300) -> Column:
    """Seconds until the next attempt: 5, 10, 20, ... up to the limit."""
    return F.least(F.lit(most).cast("long"), (F.lit(5) * F.pow(F.lit(2.0), F.least(F.greatest(attempt - 1, F.lit(0)), F.lit(20)))).cast("long"))


def ratio(part: Column, whole: Column) -> Column:
    return F.round(part / F.greatest(whole, F.lit(1)), 4)
