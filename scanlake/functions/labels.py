"""Text labels: byte sizes, durations, rates, cut columns, item labels, key:value text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanlake.functions.binding import bound
from scanlake.functions.jsontext import PLAIN_JSON, is_single_object

NANOS_PER_SECOND = 1_000_000_000
# The Unicode white space characters.
_SPACES = " \t\n\u000b\f\r\u0085\u00a0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)


def rfc3339(ts: Column) -> Column:
    """RFC 3339 text in UTC with the fraction cut after its last non-zero digit."""
    utc = F.to_utc_timestamp(ts.cast("timestamp"), F.current_timezone())
    return F.concat(F.replace(utc.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def one_decimal(value: Column, signed: bool = False) -> Column:
    """One decimal, correctly rounded from the exact binary value, exact ties to even.

    ``format_string`` rounds the shortest decimal text half up. That differs only next to
    the midpoint of two results (1.25, 0.35), so only there the exact comparison runs.
    """
    number = value.cast("double")
    size = F.abs(number)
    twenty = F.rint(size * 20)
    near_middle = (twenty % 2 == 1) & (F.abs(size * 20 - twenty) < 1e-6)
    exact = F.when((size < 1e15) & (near_middle | (size > 1e8)), bound(size, _rounded_at_middle))
    text = F.coalesce(exact, F.format_string("%.1f", size))
    return F.concat(F.when(number < 0, "-").otherwise("+" if signed else ""), text)


def _rounded_at_middle(size: Column) -> Column:
    """Compare the fraction f with the midpoint m/20 above its first digit.

    16f - m and then + 4f are exact near the midpoint, so the sign of 20f - m is too.
    """
    whole = F.floor(size)
    fraction = size - whole
    digit = F.floor(fraction * 10)
    side = (fraction * 16 - (digit * 2 + 1)) + fraction * 4
    up = (side > 0) | ((side == 0) & (digit % 2 == 1))
    return bound(
        whole * 10 + digit + up.cast("int"),
        lambda tenths: F.format_string("%d.%d", _quotient(tenths, 10), tenths % 10),
    )


def signed_rate(rate: Column, unit: str = "") -> Column:
    """``+1.5`` / ``-0.2``; a zero rate is ``0.0`` without sign."""
    return F.concat(
        F.when(rate == 0, "0.0").otherwise(one_decimal(rate, signed=True)), F.lit(unit)
    )


def format_bytes(size: Column) -> Column:
    """``N B`` below 1024, else one decimal with KB, MB, GB, TB, PB or EB."""
    size = size.cast("bigint")
    divisor, unit = F.when(size < 1024**2, 1024.0), F.when(size < 1024**2, "K")
    for power, letter in enumerate("MGTPE", start=2):
        below = size < 1024 ** (power + 1) if power < 6 else F.lit(True)
        divisor, unit = divisor.when(below, float(1024**power)), unit.when(below, letter)
    scaled = F.concat(one_decimal(size / divisor), F.lit(" "), unit, F.lit("B"))
    return F.when(size < 1024, F.concat(size.cast("string"), F.lit(" B"))).otherwise(scaled)


def format_duration(nanos: Column) -> Column:
    """``1h 2m 3s``, ``2m 3s`` or ``3s`` from nanoseconds, rounded half away from zero."""
    nanos = nanos.cast("bigint")
    # Whole seconds plus the rounded rest: adding half a second first could overflow.
    rest = nanos % NANOS_PER_SECOND
    half = NANOS_PER_SECOND // 2
    seconds = _quotient(nanos, NANOS_PER_SECOND) + (
        F.when(rest >= half, 1).when(rest <= -half, -1).otherwise(0)
    )
    hours, minutes = _quotient(seconds, 3600), _quotient(seconds % 3600, 60)
    return (
        F.when(hours > 0, F.format_string("%dh %dm %ds", hours, minutes, seconds % 60))
        .when(minutes > 0, F.format_string("%dm %ds", minutes, seconds % 60))
        .otherwise(F.format_string("%ds", seconds % 60))
    )


def _quotient(value: Column, by: int) -> Column:
    """Integer division that truncates toward zero."""
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def cut_bytes(text: Column, limit: int, mark: str = "...") -> Column:
    """Text over ``limit`` bytes becomes at most ``limit - 3`` bytes plus ``...``.

    The cut never splits a character, so the result stays valid UTF-8.
    """
    room = limit - len(mark)
    raw = text.cast("binary")
    heads = [
        F.try_validate_utf8(F.substring(raw, 1, room - back).cast("string")) for back in range(4)
    ]
    return F.when(F.octet_length(text) > limit, F.concat(F.coalesce(*heads), F.lit(mark))).otherwise(text)


def ellipsize(text: Column, limit: int) -> Column:
    """Column cut: over 25 bytes -> 22 and ``...``; over 20 -> 17 and ``...``."""
    return cut_bytes(text, limit)


def _is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _text(fields: Column, key: str) -> Column:
    value = F.try_element_at(fields, F.lit(key))
    return F.when(_is_text(value), F.variant_get(value, "$", "string"))


def item_label(item: Column) -> Column:
    """Short label of a queued JSON item.

    org/name, else repository, else the last two parts of url, else the first non-empty
    text field in key order, else the raw text cut at 50 bytes. Only JSON strings count:
    a numeric org is no org.
    """
    fields = F.when(is_single_object(item), F.from_json(item, "map<string,variant>", PLAIN_JSON))
    return F.coalesce(bound(fields, _field_label), cut_bytes(item, 50))


def _field_label(fields: Column) -> Column:
    org, name, url = _text(fields, "org"), _text(fields, "name"), _text(fields, "url")
    texts = F.transform(
        F.filter(F.map_entries(fields), lambda e: _is_text(e["value"])),
        lambda e: F.struct(e["key"].alias("k"), F.variant_get(e["value"], "$", "string").alias("v")),
    )
    first = F.array_min(F.filter(texts, lambda e: e["v"] != ""))
    return F.coalesce(
        F.concat(org, F.lit("/"), name),
        _text(fields, "repository"),
        F.when(F.contains(url, F.lit("/")), F.concat_ws("/", F.slice(F.split(url, "/"), -2, 2))).otherwise(url),
        F.concat(first["k"], F.lit(": "), first["v"]),
    )


def parse_info(text: Column) -> Column:
    """Map of ``key:value`` lines: split at the first colon, trimmed, the last one wins."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.contains(line, F.lit(":")))
    entries = F.array_sort(
        F.transform(
            lines,
            lambda line, i: F.struct(
                _trimmed(F.substring_index(line, ":", 1)).alias("key"),
                i.alias("pos"),
                _trimmed(F.substr(line, F.position(F.lit(":"), line) + 1)).alias("value"),
            ),
        )
    )
    # Sorted by key and position, an entry is the last of its key when the next key differs.
    following = F.concat(
        F.slice(F.transform(entries, lambda e: e["key"]), F.lit(2), F.size(entries)),
        F.array(F.lit(None).cast("string")),
    )
    last = F.filter(
        F.arrays_zip(entries.alias("entry"), following.alias("next_key")),
        lambda z: ~z["next_key"].eqNullSafe(z["entry"]["key"]),
    )
    return F.map_from_entries(
        F.transform(last, lambda z: F.struct(z["entry"]["key"], z["entry"]["value"]))
    )


def _trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(_SPACES))
