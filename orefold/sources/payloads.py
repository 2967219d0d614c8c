"""JSON payloads to typed rows.

A ``Shape`` says how the items of a payload look: columns with their aliases and types, an inner array to explode, what comes
from the request. ``flatten`` turns raw rows into typed ones by it, one explode per array, and keeps the latest by key.
A field's value is its first alias that is given; a measured 0 or false is a value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.merge import latest

TYPES: dict[str, Callable[[Column], Column]] = {
    "text": S.text,
    "id": S.identifier,
    "uuid": lambda c: F.coalesce(S.uuid(c), S.identifier(c)),
    "number": S.finite,
    "int": S.whole,
    "bool": S.boolean,
    "time": S.moment,
    "date": S.day,
    "json": lambda c: c,
}


@dataclass(frozen=True)
class Shape:
    """columns: name to (aliases, type); an alias may be a path such as ``team.id``, ``params.x`` looks at the request and ``account`` is the raw row's own account.
    arrays: paths of inner arrays, the first that is given is exploded (``up.x`` in columns then is a field of the item above).
    counter: a column that defaults to the 1-based place in its array. first: of a key's items in one payload the first counts, not the last."""

    columns: dict[str, tuple[str, str]]
    keys: list[str]
    arrays: list[str] = field(default_factory=list)
    counter: str | None = None
    required: list[str] = field(default_factory=list)
    first: bool = False


def _shape(keys: str, arrays: str = "", counter: str | None = None, required: str = "", first: bool = False, **columns: str) -> Shape:
    """columns as ``name="type alias|alias"``."""
    parsed = {n: (v.split(" ", 1)[1], v.split(" ", 1)[0]) for n, v in columns.items()}
    return Shape(parsed, keys.split(), arrays.split(), counter, (required or keys).split(), first)


def _force(prefixes: list[str], metrics: dict[str, str]) -> dict[str, str]:
    """Columns such as inner_left_max_force of fields such as innerLeftMaxForce."""
    out = {}
    for p in prefixes:
        words = p.split("_")
        camel = words[0] + "".join(w.title() for w in words[1:])
        for m, f in metrics.items():
            out[f"{p}_{m}"] = f"number {camel}{f}"
    return out


_TEST = {"tenant_id": "uuid tenantId|teamId|params.tenantId", "profile_id": "uuid profileId|athleteId|hubAthleteId", "modified_at": "time modifiedDateUtc|modifiedUtc|modifiedDateUTC"}
_DEFAULT = {"max_force": "MaxForce", "avg_force": "AvgForce", "impulse": "Impulse", "repetitions": "Repetitions"}

SHAPES: dict[str, Shape] = {
    "profiles": _shape("profile_id", profile_id="uuid id|profileId", tenant_id="uuid tenantId|teamId|params.tenantId", given_name="text givenName", family_name="text familyName", external_id="text externalId", date_of_birth="date dateOfBirth"),
    "profile_categories": _shape("profile_id category_id", "attributes", profile_id="uuid up.id|up.profileId", tenant_id="uuid up.tenantId|params.tenantId", category_id="uuid attributeTypeId", category_name="text typeName", group_id="uuid attributeValueId", group_name="text valueName", first=True),
    "plate_tests": _shape("test_id", test_id="uuid id|testId", test_type="text testType", weight="number weight", recorded_at="time recordedDateUtc|recordedDateUTC|recordedUtc", analysed_at="time analysedDateUtc|analysedDateUTC", attributes="json extendedParameters", **_TEST),
    "plate_definitions": _shape("result_id", "resultDefinitions items", result_id="id resultId|id", result_name="text resultName|name", result_group="text resultGroup", result_unit="text resultUnitName|resultUnit", trend="text trendDirection"),
    "plate_trials": _shape("trial_id", trial_id="uuid id", test_id="uuid testId|params.testId", profile_id="uuid profileId|athleteId", recorded_at="time recordedUtc|recordedUTC", limb="text limb"),
    "plate_results": _shape("trial_id result_id limb repeat", "results", required="trial_id result_id", trial_id="uuid up.id", test_id="uuid up.testId|params.testId", profile_id="uuid up.profileId|up.athleteId", result_id="id resultId|definition.id|definition.resultId", value="number value", at="number time", limb="text limb|up.limb", repeat="int repeat"),
    "frame_tests": _shape("test_id", test_id="uuid testId|id", test_type="text testTypeName|testType", position="text testPositionName|position", test_date="time testDateUtc|testDateUTC", notes="text notes", **_TEST, **_force(["inner_left", "inner_right", "outer_left", "outer_right"], _DEFAULT)),
    "frame_metrics": _shape("test_id", test_id="uuid params.testId|testId", tenant_id="uuid params.tenantId|tenantId", metrics="json $"),
    "frame_traces": _shape("test_id tick", "forces", counter="tick", required="test_id", test_id="uuid params.testId|up.testId", tick="int tick|sampleIndex|index", inner_left="number innerLeftForce", inner_right="number innerRightForce", outer_left="number outerLeftForce", outer_right="number outerRightForce"),
    "hamstring_tests": _shape("test_id", test_id="uuid testId|id", test_type="text testTypeName|testType", test_date="time testDateUtc|testDateUTC", device="text device", **_TEST, **_force(["left", "right"], _DEFAULT | {"torque": "Torque", "calibration": "Calibration"})),
    "hamstring_metrics": _shape("test_id", test_id="uuid params.testId|testId", tenant_id="uuid params.tenantId|tenantId", metrics="json $"),
    "hamstring_exercises": _shape("exercise_id", exercise_id="uuid id|exerciseId", test_id="uuid testId|params.testId", name="text exerciseName|name", started_at="time startTimeUtc|startUtc"),
    "hamstring_repetitions": _shape("repetition_id", repetition_id="uuid id|repetitionId", exercise_id="uuid exerciseId|params.exerciseId", number="int repetitionNumber|number", left_force="number leftMaxForce|leftForce", right_force="number rightMaxForce|rightForce"),
    "gate_summaries": _shape("test_id", test_id="uuid id|testId", test_name="text testName", test_type="text testTypeName|testType", test_date="time testDateUtc|testDateUTC", rep_count="int repCount", fields="json runningSummaryFields|jumpingSummaryFields", **_TEST),
    "gate_details": _shape("test_id", test_id="uuid params.testId|testId|id", profile_id="uuid profileId|athleteId", results="json additionalTestResult", reps="json repResults"),
    "gate_reps": _shape("test_id rep_number", "repResults", counter="rep_number", required="test_id", test_id="uuid params.testId|up.testId|up.id", rep_number="int repNumber|repIndex", reaction_time="number reactionTime", jumps="json jumpResults", splits="json splitResults"),
    "dynamo_tests": _shape("test_id", test_id="uuid id|testId", body_region="text bodyRegion", movement="text movement", position="text position", laterality="text laterality", start_at="time startTimeUtc|startTimeUTC", summaries="json repetitionTypeSummaries|repetitionSummaries|summaries", **_TEST),
    "dynamo_summaries": _shape(
        "test_id movement_type side", "repetitionTypeSummaries repetitionSummaries summaries", required="test_id", test_id="uuid up.id|up.testId|params.testId", movement_type="text movement|movementType|repetitionType", side="text laterality|side",
        rep_count="int repCount|repetitionCount", max_force_newtons="number maxForceNewtons|maxForce", avg_force_newtons="number avgForceNewtons|avgForce", max_impulse_ns="number maxImpulseNewtonSeconds|maxImpulseNs|maxImpulse",
        avg_impulse_ns="number avgImpulseNewtonSeconds|avgImpulseNs|avgImpulse", max_rfd_nps="number maxRateOfForceDevelopmentNewtonsPerSecond|maxRfdNps|maxRfd", max_rom_degrees="number maxRangeOfMotionDegrees|maxRomDegrees|maxRom",
    ),
    "dynamo_repetitions": _shape(
        "test_id repetition_number side", "repetitions", counter="repetition_number", required="test_id", test_id="uuid params.testId|up.id", repetition_number="int repetitionNumber", side="text laterality|side", impulse_ns="number impulseNewtonSeconds|impulseNs|impulse",
        rfd_nps="number rateOfForceDevelopmentNewtonsPerSecond|rfdNps|rfd", time_to_peak_s="number timeToPeakForceSeconds|timeToPeakSeconds|timeToPeak", rom_degrees="number rangeOfMotionDegrees|romDegrees|rom",
    ),
    "dynamo_traces": _shape("test_id", test_id="uuid params.testId|testId", tenant_id="uuid params.tenantId|tenantId", trace="json $"),
    "teams": _shape("source_account team_id", team_id="id id", name="text name", source_account="text account|params.source_account"),
    "positions": _shape("source_account position_id", position_id="id id", name="text name", slug="text slug", sport="text sport_name", source_account="text account|params.source_account"),
    "parameters": _shape("source_account parameter_id", parameter_id="id id", name="text name", slug="text slug", unit="text unit_type|unit", source_account="text account|params.source_account"),
    "venues": _shape("source_account venue_id", venue_id="id id", name="text name", source_account="text account|params.source_account"),
    "tag_types": _shape("source_account tag_type_id", tag_type_id="id id", name="text name", source_account="text account|params.source_account"),
    "tags": _shape("source_account tag_id", tag_id="id id", tag_type_id="id tag_type_id|tag_type.id", name="text name", source_account="text account|params.source_account"),
    "athletes": _shape("source_account athlete_id", athlete_id="id id", first_name="text first_name", last_name="text last_name", nickname="text nickname", team_id="id current_team_id|current_team.id", position_id="id position_id|position.id", height="number height", weight="number weight", is_synced="bool is_synced", created_at="time created_at", source_account="text account|params.source_account"),
    "activities": _shape("source_account activity_id", activity_id="id id", name="text name", start_time="time start_time", end_time="time end_time", duration="number duration", source_account="text account|params.source_account"),
    "periods": _shape("source_account period_id", period_id="id id", activity_id="id activity_id|params.activity_id", name="text name", start_time="time start_time", end_time="time end_time", duration="number duration", source_account="text account|params.source_account"),
    "sensor": _shape("source_account athlete_id activity_id seconds hundredths latitude longitude speed", "data", required="source_account athlete_id activity_id seconds", athlete_id="id athlete_id|params.athlete_id", activity_id="id activity_id|params.activity_id", seconds="number ts", hundredths="number cs", latitude="number latitude|lat", longitude="number longitude|long", speed="number velocity|v", heart_rate="number heart_rate|hr", source_account="text account|params.source_account"),
}


@dataclass(frozen=True)
class _Texts:
    """Fields of a JSON value by their paths, all of them taken out as text in one pass over the value.

    Names of fields may differ by case alone, so once they are taken out they go by their place.
    """

    fields: dict[str, dict]

    @staticmethod
    def of(paths: list[str]) -> _Texts:
        """Of all paths but those that others go on from."""
        fields: dict[str, dict] = {}
        for path in paths:
            if not any(p.startswith(f"{path}.") for p in paths):
                at = fields
                for name in path.split("."):
                    at = at.setdefault(name, {})
        return _Texts(fields)

    def type(self, named: bool) -> str:
        return "struct<" + ", ".join((f"`{n}`" if named else f"f{i}") + ": " + (_Texts(f).type(named) if f else "string") for i, (n, f) in enumerate(self.fields.items())) + ">"

    def get(self, variant: Column) -> Column:
        return F.try_variant_get(variant, "$", self.type(True)).cast(self.type(False)) if self.fields else F.lit(None)

    def each(self, variant: Column) -> Column:
        """Of an array's items or, of anything else, of itself."""
        listed = F.try_variant_get(variant, "$", f"array<{self.type(True)}>").cast(f"array<{self.type(False)}>")
        return F.coalesce(listed, F.when(variant.isNotNull(), F.array(self.get(variant))))

    def text(self, taken: Column, path: str) -> Column | None:
        """None for a path that isn't among them."""
        at = self.fields
        for name in path.split("."):
            if name not in at:
                return None
            taken, at = taken[f"f{list(at).index(name)}"], at[name]
        return None if at else taken


def _list(variant: Column) -> Column:
    """Items of an array or, of anything else, itself."""
    return F.coalesce(F.try_variant_get(variant, "$", "array<variant>"), F.when(variant.isNotNull(), F.array(variant)))


def _given(variant: Column, names: list[str]) -> Column:
    """The first of an object's fields that is given, as JSON. They are looked up in one pass, as a path that leads nowhere takes long."""
    kind = lambda name: "struct<" + ", ".join(f"{name(i)}: variant" for i in range(len(names))) + ">"
    found = F.try_variant_get(variant, "$", kind(lambda i: f"`{names[i]}`")).cast(kind(lambda i: f"f{i}"))
    return F.coalesce(*[found[f"f{i}"] for i in range(len(names))])


def rows_of(raw: DataFrame, shape: Shape | str) -> DataFrame:
    """Typed rows with raw_id, pos and reject_reason (NULL for a good row).

    What is read as text is taken out of an item in one pass and typed there, as the explode makes its row: told from columns, types would be told again by each filter
    on them, in code too large to be compiled. What stays JSON is taken out above that, where it is left out if nobody reads it.
    """
    shape = SHAPES[shape] if isinstance(shape, str) else shape
    wanted: dict[str, list[str]] = {"": [], "up": [], "params": []}
    whole = set()  # of these the JSON itself is needed, not only its texts

    def split(path: str) -> tuple[str, str]:
        """Where a path looks, and for what."""
        source, _, rest = path.partition(".")
        return (source, rest) if source in ("up", "params") and rest else ("", path)

    for aliases, kind in shape.columns.values():
        for source, path in map(split, aliases.split("|")):
            if kind == "json":
                whole.add(source)
            elif path != "account" or source:
                wanted[source].append(path)
    texts = {source: _Texts.of([p for p in paths if p != "$"]) for source, paths in wanted.items()}
    whole |= {source for source, paths in wanted.items() if any(p == "$" or texts[source].text(F.lit(None), p) is None for p in paths)}

    def flat(source: str) -> list[Column]:
        """What is taken above the items, a column for each text."""
        each = [texts[source].text(F.col(f"__{source}_texts"), p) for p in dict.fromkeys(wanted[source])]
        return [c.alias(f"__{source}_{i}") for i, c in enumerate(each) if c is not None] + ([F.col(f"__{source}")] if source in whole else [])

    def taken(source: str, variant: Column, name: str) -> list[Column]:
        """A value's texts as ``name``_texts, and the value itself if that is needed."""
        return ([texts[source].get(variant).alias(f"{name}_texts")] if texts[source].fields else []) + ([variant.alias(name)] if source in whole else [])

    plain = [c for c, (_, kind) in shape.columns.items() if kind != "json"]

    def first(name: str, item: Column, item_texts: Column) -> Column:
        """The first alias that is given, in its type."""
        aliases, kind = shape.columns[name]
        given = []
        for source, path in map(split, aliases.split("|")):
            at = F.col(f"__{source}") if source else item
            inside = "$" if path == "$" else f"$.{path}"
            text = texts[source].text(item_texts, path)
            if source and text is not None:
                text = F.col(f"__{source}_{list(dict.fromkeys(wanted[source])).index(path)}")
            if path == "account" and not source:
                given.append(F.col("__account"))
            elif kind == "json":
                given.append(F.to_json(F.try_variant_get(at, inside, "variant")))
            else:
                given.append(F.try_variant_get(at, inside, "string") if text is None else text)
        return TYPES[kind](F.coalesce(*[g if kind == "json" else F.when(g != "", g) for g in given]))

    def typed(item: Column, item_texts: Column) -> Column:
        return F.struct(*[first(c, item, item_texts).alias(c) for c in plain], F.lit(0).alias("__any")).alias("__typed")

    account = F.col("source_account") if "source_account" in raw.columns else F.lit(None).cast("string")
    asked = raw.select("raw_id", account.alias("__account"), F.try_parse_json(F.coalesce("request_params", F.lit("{}"))).alias("__asked"), F.try_parse_json("response_payload").alias("__payload"))
    base = asked.select("raw_id", "__account", *taken("params", F.col("__asked"), "__params"), "__payload").select("raw_id", "__account", *flat("params"), "__payload")
    kept = [c for c in base.columns if c != "__payload"]
    data = F.coalesce(_given(F.col("__payload"), ["items"]), F.col("__payload")) if not {"items", "resultDefinitions", "forces", "data"} & set(shape.arrays) else F.col("__payload")
    top = base.select(*kept, data.alias("__top"))

    def opened(rows: DataFrame, array: str, *more: str) -> DataFrame:
        """A row for each item of ``array``."""
        none = F.lit(None)
        if "" not in whole and texts[""].fields:
            each = F.transform(texts[""].each(F.col(array)), lambda x: F.struct(typed(none, x)))
        else:
            both = F.transform(_list(F.col(array)), lambda x: F.struct(*taken("", x, "__item"), F.lit(0).alias("__any")))
            each = F.transform(both, lambda x: F.struct(*([x["__item"].alias("__item")] if "" in whole else []), typed(x["__item"] if "" in whole else none, x["__item_texts"] if texts[""].fields else none)))
        return rows.select(*kept, *more, F.posexplode(each).alias("place", "__f")).select(*kept, *more, "place", "__f.*")

    if shape.arrays:
        items = top.select(*kept, F.posexplode(_list(F.col("__top"))).alias("__top_pos", "__above"))
        inner = _given(F.col("__above"), shape.arrays)
        bare = {"resultDefinitions", "forces", "items", "data"} & set(shape.arrays)
        above = taken("up", F.col("__above"), "__up")
        named = items.select(*kept, "__top_pos", *above, (F.coalesce(inner, F.col("__above")) if bare else inner).alias("__inner")).select(*kept, "__top_pos", *flat("up"), "__inner")
        more = [c for c in named.columns if c not in kept and c not in ("__top_pos", "__inner")]
        items = opened(named, "__inner", "__top_pos", *more).withColumn("pos", F.col("__top_pos").cast("long") * F.lit(1_000_000_000) + F.col("place"))
    else:
        items = opened(top, "__top").withColumn("pos", F.col("place").cast("long"))
    out = items.select("raw_id", "pos", "place", *[(F.col("__typed")[c] if c in plain else first(c, F.col("__item"), F.lit(None))).alias(c) for c in shape.columns])
    if shape.counter and shape.counter != "tick":
        out = out.withColumn(shape.counter, F.coalesce(shape.counter, (F.col("place") + 1).cast("bigint")))
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in shape.required]
    return out.drop("place").withColumn("reject_reason", F.coalesce(*missing))


def _good(rows: DataFrame, shape: Shape) -> DataFrame:
    good = rows.where("reject_reason is null").drop("reject_reason")
    if shape.counter == "tick":
        good = _ticks(good)
    return latest(good, shape.keys, [F.desc("raw_id"), F.asc("pos") if shape.first else F.desc("pos")])


def flatten(raw: DataFrame, shape: Shape | str) -> DataFrame:
    """The good rows, the latest per key (by raw_id, then place)."""
    shape = SHAPES[shape] if isinstance(shape, str) else shape
    return _good(rows_of(raw, shape), shape)


@dataclass(frozen=True)
class Load:
    """``rows`` as ``flatten`` gives them, and what the run that writes them sees on its way: nothing is flattened twice.

    A stage that runs again after an executor is lost may be counted again, as with all of Spark's observed metrics.
    """

    rows: DataFrame
    seen: Observation
    reasons: tuple[str, ...]

    def counts(self) -> dict[str, int]:
        """attempted, loaded (before repeats of a key fall together), skipped; waits for an action on ``rows``."""
        got = self.seen.get
        return {k: got[k] or 0 for k in ("attempted", "loaded", "skipped")}

    def skipped(self) -> dict[str, int]:
        """Items left out by reason."""
        got = self.seen.get
        return {r: got[r] for r in self.reasons if got[r]}


def load(raw: DataFrame, shape: Shape | str) -> Load:
    """Flattens and counts in one pass."""
    shape = SHAPES[shape] if isinstance(shape, str) else shape
    reasons = tuple(f"missing {c}" for c in shape.required)
    bad = F.col("reject_reason").isNotNull()
    seen = Observation()
    rows = rows_of(raw, shape).observe(
        seen, F.count("*").alias("attempted"), F.count_if(~bad).alias("loaded"), F.count_if(bad).alias("skipped"), *[F.count_if(F.col("reject_reason") == r).alias(r) for r in reasons]
    )
    return Load(_good(rows, shape), seen, reasons)


def with_parent(rows: DataFrame, parents: DataFrame, key: str, take: dict[str, str], *, required: str | None = None) -> DataFrame:
    """``rows`` with columns of their parent where they have none of their own (``take``: own name to the parent's), and a reject_reason where
    ``required`` stays empty."""
    p = parents.select(F.col(key).alias("__key"), *[F.col(v).alias(f"__{k}") for k, v in take.items()])
    out = rows.join(p, F.col(key) == F.col("__key"), "left").drop("__key")
    for k in take:
        out = out.withColumn(k, F.coalesce(k, f"__{k}") if k in rows.columns else F.col(f"__{k}")).drop(f"__{k}")
    return out.withColumn("reject_reason", F.when(F.col(required).isNull(), F.lit(f"missing {required}")) if required else F.lit(None).cast("string"))


def count_items(payload: Column) -> Column:
    """Items of a payload: a list's, those under ``items``, one for any other object, none for what is neither."""
    v = F.try_parse_json(payload)
    listed = F.coalesce(F.try_variant_get(v, "$.items", "array<variant>"), F.try_variant_get(v, "$", "array<variant>"))
    return F.when(v.isNull(), 0).otherwise(F.coalesce(F.size(listed), F.try_variant_get(v, "$", "map<string, variant>").isNotNull().cast("int")))


def _ticks(rows: DataFrame) -> DataFrame:
    from ..operators.fact import fill_ticks

    w = Window.partitionBy("raw_id").orderBy("pos")
    placed = rows.withColumn("__at", F.row_number().over(w) - 1)
    return fill_ticks(placed, "raw_id", "__at", "tick").withColumn("tick", F.col("filled_tick")).drop("filled_tick", "__at")


def with_placeholders(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, keep: list[str]) -> DataFrame:
    """Parents, and a nameless one for each child key that has none."""
    wanted = children.where(F.col(child_key).isNotNull()).select(*keep, F.col(child_key).alias(parent_key)).distinct()
    new = wanted.join(parents, [*keep, parent_key], "left_anti")
    return parents.unionByName(new, allowMissingColumns=True)


def athletes(raw: DataFrame) -> DataFrame:
    return flatten(raw, "athletes").withColumn("full_name", S.full_name(F.col("first_name"), F.col("last_name")))


def with_duration(rows: DataFrame) -> DataFrame:
    return rows.withColumn("duration", S.duration(F.col("duration"), F.col("start_time"), F.col("end_time")))


def _latest_by_hash(rows: DataFrame, parts: list[Column], order: list[Column], keys: list[str] = ()) -> DataFrame:
    """With record_hash, a hash of ``parts``, and the latest by it (and ``keys``). Its bytes are shuffled and sorted, half as long as the text that they become."""
    keyed = rows.withColumn("record_hash", F.unhex(S.record_hash(*parts)))
    return latest(keyed, [*keys, "record_hash"], order).withColumn("record_hash", F.lower(F.hex("record_hash")))


def sensor(raw: DataFrame) -> DataFrame:
    """Readings, the latest of account, time and what was read; two places at one time are two readings."""
    rows = rows_of(raw, "sensor").where("reject_reason is null").drop("reject_reason")
    timed = rows.withColumn("recorded_at", S.sensor_time(F.col("seconds"), F.col("hundredths"))).where("recorded_at is not null")
    read = ("source_account", "activity_id", "athlete_id", "recorded_at", "latitude", "longitude", "speed")
    return _latest_by_hash(timed, [F.col(c) for c in read], [F.desc("raw_id"), F.desc("pos")], ["source_account", "recorded_at"])


def entity_tags(raw: DataFrame) -> DataFrame:
    """record_hash, entity and tag ids, of a list or an object with items."""
    shape = _shape("entity_id tag_id", entity_id="id entity_id|entity.id", entity_type="text entity_type", tag_id="id tag_id|tag.id", source_account="text account|params.source_account")
    rows = rows_of(raw, shape).where("reject_reason is null").drop("reject_reason")
    return _latest_by_hash(rows, [F.col(c) for c in ("source_account", "entity_type", "entity_id", "tag_id")], [F.desc("raw_id"), F.desc("pos")])


def annotations(raw: DataFrame, scope: str) -> DataFrame:
    """The scope (activity, period or athlete) says which one target id stays."""
    shape = _shape("source_account annotation_id", annotation_id="id id", activity_id="id activity_id|params.activity_id", period_id="id period_id|params.period_id", athlete_id="id athlete_id|params.athlete_id", body="text comment|text", source_account="text account|params.source_account")
    rows = flatten(raw, shape).withColumn("annotation_scope", F.lit(scope))
    return rows.withColumns({f"{s}_id": F.col(f"{s}_id") if s == scope else F.lit(None).cast("string") for s in ("activity", "period", "athlete")})


STAT_KEYS = ["activity_id", "activity_id_id", "athlete_id", "athlete_id_id", "period_id", "period_id_id", "start_time"]


def stats(raw: DataFrame, activities: DataFrame, periods: DataFrame) -> DataFrame:
    """Statistics rows, the latest of account, activity, athlete, start and period: ids with suffixed aliases (a 0 is none), times of the parent activity, the period only if it is known, and
    all other fields as a map. Rows without activity or athlete carry a reject_reason."""

    def typed(m: Column) -> Column:
        ids = [S.dimension_id(m[c], m[f"{c}_id"]).alias(name) for c, name in (("activity_id", "activity_id"), ("athlete_id", "athlete_id"), ("period_id", "period_key"))]
        return F.struct(*ids, S.moment(m["start_time"]).alias("own_start"), S.remainder(m, STAT_KEYS).alias("all_parameters"))

    # typed as the explode makes its row: told from columns, ids would be told again by each filter and join on them, in code too large to be compiled
    listed = F.transform(F.from_json("response_payload", "array<map<string,string>>"), typed)
    rows = raw.select("raw_id", "source_account", F.posexplode(listed).alias("pos", "row")).select("raw_id", "pos", "source_account", "row.*")
    a = activities.select("source_account", "activity_id", F.col("start_time").alias("activity_start"), F.col("end_time").alias("end_time"))
    p = periods.select("source_account", F.col("period_id").alias("period_key"), F.col("period_id"))
    joined = rows.join(a, ["source_account", "activity_id"], "left").join(p, ["source_account", "period_key"], "left")
    reason = F.when(F.col("activity_id").isNull(), "missing activity_id").when(F.col("athlete_id").isNull(), "missing athlete_id")
    out = joined.withColumn("start_time", F.coalesce("own_start", "activity_start")).withColumn("reject_reason", reason).drop("own_start", "activity_start")
    good = latest(out.where("reject_reason is null"), ["source_account", "activity_id", "athlete_id", "start_time", "period_key"], [F.desc("raw_id"), F.desc("pos")])
    # a reason that can't be NULL, so that nothing is read for rejected rows where only good ones are asked for
    bad = out.where("reject_reason is not null").withColumn("reject_reason", F.when(F.col("activity_id").isNull(), "missing activity_id").otherwise("missing athlete_id"))
    return good.unionByName(bad).drop("pos")


def efforts(raw: DataFrame) -> DataFrame:
    """Velocity and acceleration efforts of both payload shapes: type with band, start, end, value."""
    one = "struct<start_time:string,end_time:string,band:int,distance:double,max_velocity:double,acceleration:double>"
    listed = F.substring(F.ltrim("response_payload"), 1, 1) == "["
    kept = ("raw_id", "source_account", "request_params")
    flat = F.when(~listed, F.from_json("response_payload", f"struct<velocity:array<{one}>,acceleration:array<{one}>>"))
    nested = F.when(listed, F.from_json("response_payload", f"array<struct<data:struct<velocity_efforts:array<{one}>,acceleration_efforts:array<{one}>>>>"))
    empty = F.from_json(F.lit("[]"), f"array<{one}>")

    def found(kind: str) -> Column:
        deep = F.flatten(F.transform(F.col("nested")["data"][f"{kind}_efforts"], lambda x: F.coalesce(x, empty)))
        return F.coalesce(deep, F.col("flat")[kind], empty).alias(kind)

    def typed(kind: str) -> Column:
        """As the explode makes its row, see ``rows_of``."""
        value = lambda e: F.coalesce(e["distance"], e["max_velocity"], e["acceleration"]).alias("value")
        return F.transform(kind, lambda e: F.struct(S.effort_type(F.lit(kind), e["band"]).alias("effort_type"), S.moment(e["start_time"]).alias("start_time"), S.moment(e["end_time"]).alias("end_time"), value(e)))

    parsed = raw.select(*kept, flat.alias("flat"), nested.alias("nested")).select(*kept, found("velocity"), found("acceleration"))
    rows = parsed.select(*kept, F.explode(F.concat(typed("velocity"), typed("acceleration"))).alias("e")).select(*kept, "e.*")
    return _latest_by_hash(rows, [F.col(c) for c in ("source_account", "request_params", "effort_type", "start_time", "end_time", "value")], [F.desc("raw_id")])


def events(raw: DataFrame) -> DataFrame:
    """Rows of a map of event type to events, bare or under data; unknown types are kept."""
    kinds = "map<string,array<map<string,string>>>"
    payload = F.coalesce(F.get_json_object("response_payload", "$.data"), F.get_json_object("response_payload", "$[0].data"), F.col("response_payload"))
    one = raw.select("raw_id", "source_account", "request_params", F.explode(F.from_json(payload, kinds)).alias("event_type", "each"))
    rows = one.select("raw_id", "source_account", "request_params", "event_type", F.explode("each").alias("fields"))
    typed = rows.withColumn("start_time", S.moment(F.col("fields")["start_time"]))
    return _latest_by_hash(typed, [F.col("source_account"), F.col("request_params"), F.col("event_type"), F.to_json("fields")], [F.desc("raw_id")])
