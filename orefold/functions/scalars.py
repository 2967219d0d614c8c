"""Scalar functions as Column expressions: names, sides, units, numbers, times, identifiers.

All take and give Columns, never raise on bad text (``try_`` casts), and give NULL for NULL unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED values: side labels after normalising a name, and prefixes of metric names that are sides.
SIDES = {
    "left": "left",
    "left_side": "left",
    "right": "right",
    "right_side": "right",
    "bilateral": "bilateral",
    "both": "bilateral",
    "trial": "trial",
    "inner_left": "inner_left",
    "inner_right": "inner_right",
    "outer_left": "outer_left",
    "outer_right": "outer_right",
    "left_then_right": "left_then_right",
    "right_then_left": "right_then_left",
}
SIDE_PREFIX = "^(inner_left|inner_right|outer_left|outer_right|left|right)_(.*)$"
LIMB_SIDES = {"left": "left", "leftside": "left", "right": "right", "rightside": "right", "both": "bilateral", "bilateral": "bilateral", "trial": "trial"}
# FIXED values: units by pattern of the metric name; the first that matches counts.
UNITS = [
    ("flight_time|contact_time", "ms"),
    ("_kg$|weight_kg", "kg"),
    ("per_kg", "per_kg"),
    ("newtons_per_second|_nps$|_rfd_", "N/s"),
    ("newton_seconds|_ns$|impulse", "Ns"),
    ("_seconds$|_time_to_|_time$|duration", "s"),
    ("degrees|range_of_motion|_rom$", "degrees"),
    ("torque", "Nm"),
    ("force|baseline|threshold", "N"),
    ("height_m", "m"),
    ("_pct$|percent|asymmetry", "%"),
    ("repetition|_count$|^rep_count$", "count"),
]
GATE_UNITS = [("flight_time|contact_time", "ms"), ("height_m$", "m"), ("weight_kg$", "kg"), ("split_time|cumulative_time", "s"), ("^total_|^reaction_time$", "s")]
ID_KEY = "^id$|_id$|_index$|_utc$"
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def camel_to_snake(c: Column) -> Column:
    one = F.regexp_replace(c, "([A-Z]+)([A-Z][a-z])", "$1_$2")
    two = F.regexp_replace(one, "([a-z0-9])([A-Z])", "$1_$2")
    return F.lower(F.translate(two, " -", "__"))


#: Names that ``metric_name`` leaves as they are.
PLAIN_NAME = "^[a-z0-9]+(_[a-z0-9]+)*$"


def metric_name(c: Column) -> Column:
    # most names are met again and again in their final form: one look spares them four rewrites
    return F.when(c.rlike(PLAIN_NAME), c).otherwise(F.regexp_replace(F.regexp_replace(camel_to_snake(c), "_+", "_"), "^_|_$", ""))


def slug(group: Column, name: Column, number: Column) -> Column:
    joined = F.concat_ws("_", F.nullif(group, F.lit("")), F.nullif(name, F.lit("")))
    text = F.regexp_replace(F.lower(F.regexp_replace(joined, "[^A-Za-z0-9]+", "_")), "^_+|_+$", "")
    return F.coalesce(F.nullif(text, F.lit("")), F.concat(F.lit("result_"), number.cast("string")))


def _may_have_side(c: Column) -> Column:
    """True for every name that ``SIDE_PREFIX`` fits; found without a pattern."""
    return F.contains(c, F.lit("left_")) | F.contains(c, F.lit("right_"))


def side_of_name(c: Column) -> Column:
    return F.when(_may_have_side(c), F.nullif(F.regexp_extract(c, SIDE_PREFIX, 1), F.lit("")))


def name_without_side(c: Column) -> Column:
    return F.when(_may_have_side(c) & c.rlike(SIDE_PREFIX), F.regexp_extract(c, SIDE_PREFIX, 2)).otherwise(c)


def _lookup(c: Column, table: dict[str, str], other: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(pairs[c], other)


def side_label(c: Column) -> Column:
    name = metric_name(c.cast("string"))
    return _lookup(name, SIDES, F.nullif(name, F.lit("")))


def limb_side(c: Column) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    rest = F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return _lookup(low, LIMB_SIDES, F.nullif(rest, F.lit("")))


def _first_match(c: Column, rules: list[tuple[str, str]]) -> Column:
    low = F.lower(c)
    out = None
    for pattern, unit in rules:
        out = F.when(low.rlike(pattern), unit) if out is None else out.when(low.rlike(pattern), unit)
    return out


def unit(c: Column) -> Column:
    return _first_match(c, UNITS)


def gate_unit(c: Column) -> Column:
    return _first_match(c, GATE_UNITS + UNITS)


def is_id_key(c: Column) -> Column:
    return metric_name(c).rlike(ID_KEY)


def finite(c: Column) -> Column:
    """A finite double of number or text; text such as 1_000 is NULL."""
    return finite_double(c.cast("string").try_cast("double"))


def finite_double(d: Column) -> Column:
    """The same of what is a double already, without its way through text."""
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def whole(c: Column) -> Column:
    """Truncated towards zero."""
    return finite(c).try_cast("bigint")


def whole_only(c: Column) -> Column:
    d = finite(c)
    return F.when(d == F.floor(d), d.try_cast("bigint"))


def whole_text(c: Column) -> Column:
    """Text of nothing but digits, with or without a sign; 3.0 and true are NULL."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"))


def decimal(c: Column) -> Column:
    return c.cast("string").try_cast("decimal(38,18)")


def boolean(c: Column) -> Column:
    low = F.lower(F.trim(c.cast("string")))
    return F.when(low.isin("1", "true", "t", "yes", "y"), True).when(low.isin("0", "false", "f", "no", "n"), False)


def identifier(c: Column) -> Column:
    """Text without blanks at its ends; blank and boolean words are NULL."""
    text = blank_to_null(c)
    ends = F.endswith(text, F.lit("e")) | F.endswith(text, F.lit("E"))  # as both words do; few ids are left for lower case, which is slow
    return F.when(~(ends & F.lower(text).isin("true", "false")), text)


def dimension_id(plain: Column, suffixed: Column) -> Column:
    return F.coalesce(F.nullif(identifier(plain), F.lit("0")), F.nullif(identifier(suffixed), F.lit("0")))


def uuid(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.rlike(UUID), low)


def id_shape(c: Column) -> Column:
    text = F.trim(c.cast("string"))
    return F.when(F.lower(text).rlike(UUID), "uuid").when(text.rlike("^[0-9]+$"), "numeric").otherwise("text")


def clean_name(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(c, "\\s+", " ")), F.lit(""))


def full_name(*parts: Column) -> Column:
    return F.nullif(F.concat_ws(" ", *[clean_name(p) for p in parts]), F.lit(""))


def test_name(parts: list[Column], default: str) -> Column:
    return F.coalesce(F.nullif(F.concat_ws(" ", *[blank_to_null(p) for p in parts]), F.lit("")), F.lit(default))


def with_position(kind: Column, position: Column) -> Column:
    return F.when(blank_to_null(position).isNotNull(), F.concat(kind, F.lit(" - "), F.trim(position))).otherwise(kind)


def timestamp(c: Column) -> Column:
    """ISO text, a naive one being UTC (sessions run in UTC)."""
    return F.try_to_timestamp(F.trim(c.cast("string")))


def moment(c: Column) -> Column:
    """Epoch seconds, epoch milliseconds (above 1e10) or ISO text; nothing at or under zero."""
    text = c.cast("string")
    n = finite(F.when(~F.contains(text, F.lit(":")), text))  # no number has a colon; failing to read one is slow
    return F.when(n > 1e10, F.timestamp_seconds(n / 1000)).when(n > 0, F.timestamp_seconds(n)).when(n.isNull(), timestamp(c))


def day(c: Column) -> Column:
    return F.coalesce(c.cast("string").try_cast("date"), F.to_date(moment(c)))


def sensor_time(seconds: Column, hundredths: Column) -> Column:
    return F.timestamp_seconds(finite(seconds) + F.coalesce(finite(hundredths), F.lit(0.0)) / 100)


def local_day_start(date: Column, zone: str) -> Column:
    return F.to_utc_timestamp(date.cast("timestamp"), zone)


def local_date(epoch: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(moment(epoch), zone))


def utc_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def clamp(watermark: Column, cutoff: Column, day_start: Column | None = None) -> Column:
    return F.greatest(watermark, cutoff, *([day_start] if day_start is not None else []))


def duration(given: Column, start: Column, stop: Column) -> Column:
    return F.coalesce(given, stop.cast("double") - start.cast("double"))


def key_number(c: Column) -> Column:
    """A number's shortest plain text: zeros go only after a decimal point, and minus zero is 0."""
    text = c.cast("string")
    d = text.try_cast("decimal(38,12)").cast("string")
    cut = F.when(d.contains("."), F.regexp_replace(F.regexp_replace(d, "0+$", ""), "\\.$", "")).otherwise(d)
    return F.when(cut == "-0", "0").otherwise(cut)


def row_key(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def record_hash(*parts: Column) -> Column:
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)]), {"ignoreNullFields": "false"}), 256)


def json_hash(c: Column) -> Column:
    """The same for JSON texts that differ in the order of keys or in blanks."""
    return F.sha2(F.coalesce(F.to_json(F.try_parse_json(c)), c), 256)


def modified_z(x: Column, median: Column, mad: Column, least: float = 1.0) -> Column:
    return F.when(mad >= least, F.lit(0.6745) * (x - median) / mad)


def standard_z(x: Column, mean: Column, sd: Column) -> Column:
    return F.when(sd != 0, (x - mean) / sd)


def fence(p25: Column, p75: Column, times: float = 2.0) -> tuple[Column, Column]:
    return p25 - (p75 - p25) * times, p75 + (p75 - p25) * times


def asymmetry(left: Column, right: Column) -> Column:
    most = F.greatest(F.abs(left), F.abs(right))
    return F.when(most == 0, F.lit(0.0)).otherwise(F.abs(left - right) / most * 100)


def split_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "^split_(\\d+)_cumulative_time$", 1), F.lit("")).try_cast("int")


def effort_type(kind: Column, band: Column) -> Column:
    return F.concat_ws("_", kind, F.when(band.isNotNull(), F.concat(F.lit("band_"), band.cast("string"))))


def severity(value: Column, limit: Column) -> Column:
    return F.when(value > 2 * limit, "critical").when(value > limit, "warning")


def lag_limit(name: Column, special: dict[str, int] | None = None, usual: int = 6) -> Column:
    out = None
    for word, hours in (special or {"sensor_data": 12, "events": 8}).items():
        out = F.when(name.contains(word), hours) if out is None else out.when(name.contains(word), hours)
    return out.otherwise(usual)


def text(c: Column, most: int | None = None) -> Column:
    t = blank_to_null(c)
    return t if most is None else F.substring(t, 1, most)


def first_number(m: Column, preferred: list[str], ignored: list[str]) -> Column:
    """Of a map of text: the first preferred key with a number, else the first other value that is one."""
    named = [finite(m[k]) for k in preferred]
    rest = F.filter(F.map_entries(m), lambda e: ~e["key"].isin(ignored) & finite(e["value"]).isNotNull())
    return F.coalesce(*named, finite(F.get(rest, F.lit(0))["value"]))


def remainder(m: Column, keys: list[str]) -> Column:
    return F.map_filter(m, lambda k, _: ~k.isin(keys))
