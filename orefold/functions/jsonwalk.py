"""Open JSON to rows: every numeric leaf of a payload as (path, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scalars as S


#: What ``numeric_leaves`` adds to the kept columns.
LEAF = ["metric_name", "metric_value", "place"]


def depth_of(payload: Column) -> Column:
    """How deep brackets are nested in a JSON text, from one walk over them; what stands in strings doesn't count."""
    bare = F.regexp_replace(payload, r'"(?:[^"\\]|\\.)*"', "")
    brackets = F.split(F.regexp_replace(bare, r"[^\[\]{}]+", ""), "")
    step = lambda c: F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)
    begin = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def go(s: Column, c: Column) -> Column:
        return F.struct((s["now"] + step(c)).alias("now"), F.greatest(s["most"], s["now"] + step(c)).alias("most"))

    flat = payload.rlike(r"^\s*[\[{][^\[{]*$")  # one bracket that opens, at the start
    return F.when(flat, 1).otherwise(F.coalesce(F.aggregate(brackets, begin, go)["most"], F.lit(0)))


def _made_once(df: DataFrame, kept: list[str], row: list[Column], keep_if) -> DataFrame:
    """``kept`` columns and those of ``row``, for rows of which ``keep_if`` holds (a condition on a struct of ``row``). The row is made by an explode, so a filter on what was made of
    texts doesn't make it again, which filters on plain columns do."""
    return df.select(*kept, F.explode(F.filter(F.array(F.struct(*row)), keep_if)).alias("__row_made")).select(*kept, "__row_made.*")


def numeric_leaves(df: DataFrame, payload: str, *keep: str, depth: int = 5) -> DataFrame:
    """Per row and finite numeric leaf: the kept columns, metric_name (path joined by _, arrays from 1), metric_value, place.

    ``place`` is the path in positions, counted from 0 in the order of the payload's text, so that leaves compared by it come as they were written.
    (A variant keeps an object's fields by name; their order is that of the text's own keys.) Booleans and what stands under
    identifier-like keys is left out; numbers in text count. Objects and arrays deeper than ``depth`` come as rows with a NULL value and
    ``too_deep``, so nothing gets lost unseen. Each level is one explode in the JVM, through which leaves of the levels above pass as they are, so the rows are
    read once.
    """
    level = df.select(*keep, F.lit("").alias("__path"), F.array().cast("array<int>").alias("__place"), F.col(payload).alias("__text"), F.try_parse_json(F.col(payload)).alias("__v"))
    is_a = lambda kind: F.coalesce(F.startswith(F.col("__kind"), F.lit(kind)), F.lit(False))
    for _ in range(depth):
        open_ = level.withColumn("__kind", F.schema_of_variant("__v")).withColumns({"__object": is_a("OBJECT"), "__list": is_a("ARRAY")})
        open_ = open_.withColumns({"__nested": F.col("__object") | F.col("__list"), "__fields": F.from_json(F.when(F.col("__object"), F.col("__text")), "map<string,string>"), "__items": F.from_json(F.when(F.col("__list"), F.col("__text")), "array<string>")})
        open_ = open_.withColumns({"__keys": F.map_keys("__fields"), "__in": F.when(F.col("__nested"), F.col("__v"))})
        inner = open_.lateralJoin(level.sparkSession.tvf.variant_explode_outer(F.col("__in").outer()))
        named = F.col("key").isNotNull()
        at = F.coalesce(F.when(named, F.array_position("__keys", F.col("key")).cast("int") - 1), F.col("pos"))
        inner = inner.where(~F.col("__nested") | F.col("pos").isNotNull()).withColumns({"__name": S.metric_name(F.col("key")), "__at": at})
        name = F.coalesce("__name", (F.col("pos") + 1).cast("string"))
        own = F.when(named, F.col("__fields")[F.col("key")]).otherwise(F.get("__items", F.col("pos")))
        new = lambda c, then: F.when(F.col("__nested"), then).otherwise(F.col(c)).alias(c)
        row = [new("__path", F.concat_ws("_", F.nullif("__path", F.lit("")), name)), new("__place", F.concat("__place", F.array("__at"))), new("__text", own), new("__v", F.col("value"))]
        is_id = F.col("__nested") & F.coalesce(F.col("__name").rlike(S.ID_KEY), F.lit(False))
        level = _made_once(inner, keep, [*row, is_id.alias("__id")], lambda x: ~x["__id"]).drop("__id")
    kinds = level.withColumn("__kind", F.schema_of_variant("__v")).withColumn("__text", F.coalesce("__text", F.try_variant_get("__v", "$", "string")))  # its own text, as a variant takes long to become one
    nested = is_a("OBJECT") | is_a("ARRAY")
    leaf = [F.col("__path").alias("metric_name"), F.when(~nested & (F.col("__kind") != "BOOLEAN"), S.finite(F.col("__text"))).alias("metric_value"), F.col("__place").alias("place"), nested.alias("too_deep")]
    return _made_once(kinds, keep, leaf, lambda x: x["too_deep"] | (x["metric_value"].isNotNull() & (x["metric_name"] != "")))


def all_leaves(df: DataFrame, payload: str, *keep: str, depth: int | None = None) -> DataFrame:
    """The same at any depth. ``depth``: a bound that the caller knows; None looks at how deep the brackets of the payloads are nested, a scan of that
    one column."""
    if depth is None:
        depth = df.agg(F.max(depth_of(F.col(payload)))).first()[0] or 1
    return numeric_leaves(df, payload, *keep, depth=depth).where("not too_deep").drop("too_deep")


def wide_to_long(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    return df.unpivot(ids, metrics, "metric_name", "metric_value")


def wide_leaves(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """The same with ``place``, the column's place in the list."""
    at = F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("metric_name")).cast("int")
    return wide_to_long(df, ids, metrics).withColumn("place", F.array(at))


def items(payload, of: str):
    """A payload that is a list, an object with ``items`` or a single object, as an array of ``of`` (a DDL type)."""
    wrapped = F.from_json(payload, f"struct<items:array<{of}>>")["items"]
    start = F.substring(F.ltrim(payload), 1, 1)
    return F.when(start == "[", F.from_json(payload, f"array<{of}>")).otherwise(F.coalesce(wrapped, F.array(F.from_json(payload, of))))


def repetition_leaves(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Repetitions with jumps and splits inside to rows: the kept columns, rep_number, metric_name, metric_value, metric_unit, place.

    A repetition's own numbers keep their names, those of its jumps and splits become jump_<n>_<name> and split_<n>_<name>, also
    what a split has nested. Numbers of repetitions, jumps and splits default to their places, counted from one. ``place`` orders a repetition's own
    numbers before its jumps and these before its splits, each in the order of the payload.
    """
    many, one = "array<map<string,string>>", "map<string,string>"
    at = lambda m, *names: F.coalesce(*[S.whole(F.col(m)[n]) for n in names], F.col("pos") + 1)
    reps = df.select(*keep, F.posexplode(F.from_json(payload, many)).alias("pos", "rep")).select(*keep, F.col("pos").alias("__rep"), at("rep", "repIndex", "repNumber").cast("int").alias("rep_number"), "rep")
    keep = (*keep, "rep_number")

    def numbers(rows: DataFrame, m: str, prefix, ignored: list[str], *order) -> DataFrame:
        each = rows.select("*", F.posexplode(F.map_entries(m)).alias("__key", "e")).where(~F.col("e.key").isin(ignored))
        name = F.concat(prefix, S.camel_to_snake(F.col("e.key")))
        place = F.array("__rep", *order, "__key").cast("array<int>")
        return each.select(*keep, name.alias("metric_name"), S.finite(F.col("e.value")).alias("metric_value"), place.alias("place"))

    parts = [numbers(reps, "rep", F.lit(""), ["repIndex", "repNumber", "jumpResults", "splitResults"], F.lit(0))]
    for k, (kind, ignored) in enumerate((("jump", ["jumpIndex", "splitCompleteDate"]), ("split", ["splitIndex", "gateIndex", "splitCompleteDate", "additionalSplitData"])), 1):
        items_ = reps.select(*keep, "__rep", F.posexplode(F.from_json(F.col("rep")[f"{kind}Results"], many)).alias("pos", "item"))
        items_ = items_.withColumn("prefix", F.concat(F.lit(f"{kind}_"), at("item", f"{kind}Index").cast("string"), F.lit("_")))
        parts.append(numbers(items_, "item", F.col("prefix"), ignored, F.lit(k), "pos", F.lit(0)))
        if kind == "split":
            nested = items_.withColumn("more", F.from_json(F.col("item")["additionalSplitData"], one))
            parts.append(numbers(nested, "more", F.col("prefix"), [], F.lit(k), "pos", F.lit(1)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("metric_value is not null").withColumn("metric_unit", S.gate_unit(F.col("metric_name")))
