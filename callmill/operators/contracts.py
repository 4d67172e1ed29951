"""Strict contracts of JSON observations, checked on VARIANT so that no type is coerced.

Each validator returns its fields, `errors`, in the order of the checks, and `message`, what the first one says. Text that
is no JSON object has the error not_an_object. Nothing is guessed: a number in quotes is no number, 1 is no boolean. A
field that is null is there: it is refused where a text is required, and stands for its default where one is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from callmill.functions.text import fenced_json, strip

# The vocabularies of a candidate and of a verdict.
REQUIRED = ("source_id", "chunk_id", "sub_asset_class", "taxonomy_match", "view", "call_language", "evidence_kind", "evidence_quote", "locator", "reasoning")
VIEWS, MATCHES = ("O", "N", "U", "UNCERTAIN"), ("exact", "semantic", "none")
LANGUAGES = ("explicit_dial", "explicit_stance", "directional", "implied", "none")
FORMER_LANGUAGE = {"explicit": "explicit_stance"}
KINDS, BASES, UNITS = ("prose", "table", "visual"), ("stated", "forecast_delta", "inferred"), ("bp", "pct")
ANSWERS, STRENGTHS = ("pass", "unclear", "fail"), ("decisive", "adequate", "thin")


class _Object:
    """Fields of a VARIANT column by strict type."""

    def __init__(self, column: Column):
        self.v = column

    def kind(self, key: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(self.v, f"$.{key}", "variant"))

    def there(self, key: str) -> Column:
        return F.try_variant_get(self.v, f"$.{key}", "variant").isNotNull()

    def null(self, key: str) -> Column:
        """Not there, or null."""
        return ~self.there(key) | (self.kind(key) == "VOID")

    def said(self, key: str) -> Column:
        """Any value as a text, empty where it isn't there; truth values and null with a capital."""
        kind, plain = self.kind(key), F.try_variant_get(self.v, f"$.{key}", "string")
        return F.when(~self.there(key), "").when(kind == "VOID", "None").when(kind == "BOOLEAN", F.initcap(plain)).otherwise(plain)

    def text(self, key: str) -> Column:
        return F.when(self.kind(key) == "STRING", F.try_variant_get(self.v, f"$.{key}", "string"))

    def number(self, key: str) -> Column:
        return F.when(self.kind(key).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT)"), F.try_variant_get(self.v, f"$.{key}", "double"))

    def whole(self, key: str) -> Column:
        return F.when(self.kind(key).rlike("^(BIGINT|INT)"), F.try_variant_get(self.v, f"$.{key}", "bigint"))

    def boolean(self, key: str) -> Column:
        return F.when(self.kind(key) == "BOOLEAN", F.try_variant_get(self.v, f"$.{key}", "boolean"))

    def spans(self, key: str) -> Column:
        """A text as one span, a list of texts as they are; else null."""
        kind = self.kind(key)
        listed = F.when(kind == "ARRAY<STRING>", F.try_variant_get(self.v, f"$.{key}", "array<string>"))
        return F.when(kind == "STRING", F.array(F.try_variant_get(self.v, f"$.{key}", "string"))).otherwise(listed)


def _blank(x: Column) -> Column:
    return strip(F.coalesce(x, F.lit(""))) == ""


def _errors(checks: list[tuple[Column, str, str | Column]]) -> tuple[Column, Column]:
    """(names of the checks that fail, message of the first), from (fails, name, message)."""
    messages = F.array_compact(F.array(*[F.when(bad, F.lit(m) if isinstance(m, str) else m) for bad, _, m in checks]))
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for bad, name, _ in checks])), F.get(messages, 0)


def _text_check(o: _Object, key: str) -> tuple[Column, str, str]:
    return _blank(o.text(key)), key, f"{key} must be a non-empty string"


def _choice_check(o: _Object, key: str, allowed: tuple, value: Column | None = None) -> tuple[Column, str, Column]:
    value = o.text(key) if value is None else value
    return ~_in(value, allowed), key, F.when(_blank(value), f"{key} must be a non-empty string").otherwise(f"{key} must be one of {', '.join(allowed)}")


def _in(x: Column, allowed: tuple) -> Column:
    return F.coalesce(x.isin(*allowed), F.lit(False))


class _Read(_Object):
    """An object whose fields' types and texts read() has put into columns, since each of them is asked for often."""

    def kind(self, key: str) -> Column:
        return F.col(f"_kind_{key}")

    def there(self, key: str) -> Column:
        return self.kind(key).isNotNull()

    def text(self, key: str) -> Column:
        return F.col(f"_text_{key}")

    @staticmethod
    def read(x: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        o = _Object(F.col("_v"))
        kinds = x.withColumns({f"_kind_{k}": o.kind(k) for k in keys})
        return kinds.withColumns({f"_text_{k}": F.when(F.col(f"_kind_{k}") == "STRING", F.try_variant_get("_v", f"$.{k}", "string")) for k in keys})

    @staticmethod
    def drop(x: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        return x.drop(*[f"_{what}_{k}" for what in ("kind", "text") for k in keys])


def parse_object(df: DataFrame, text: str) -> DataFrame:
    """Adds _v, the object as VARIANT, null for anything else. A code fence around it is taken off; what is VARIANT already is not parsed."""
    if isinstance(df.schema[text].dataType, VariantType):
        return df.withColumn("_v", F.when(F.startswith(F.schema_of_variant(text), F.lit("OBJECT")), F.col(text)))
    # JSON that begins with a brace is an object: no need to make a schema of all that it holds
    return df.withColumn("_v", fenced_json(F.col(text))).withColumn("_v", F.when(F.startswith("_v", F.lit("{")), F.try_parse_json("_v")))


def candidates(df: DataFrame, text: str, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    asked = tuple(dict.fromkeys((*required, *REQUIRED, "sub_asset_raw", "basis", "conflict", "delta_value", "delta_unit")))
    o = _Read(F.col("_v"))
    x = o.read(parse_object(df, text), asked)
    missing = F.array_compact(F.array(*[F.when(~o.there(k), F.lit(k)) for k in required]))
    language = o.text("call_language")
    for old, new in FORMER_LANGUAGE.items():
        language = F.when(language == old, new).otherwise(language)
    basis = F.when(o.null("basis"), "stated").otherwise(o.text("basis"))
    delta = F.coalesce(basis == "forecast_delta", F.lit(False))
    spans = o.spans("evidence_quote")
    kind = o.kind("evidence_quote")
    bad_spans = F.coalesce((F.size(spans) == 0) | F.exists(spans, lambda s: _blank(s)), F.lit(True))
    no_list = ~F.coalesce(F.startswith(kind, F.lit("ARRAY")), F.lit(False))
    about_spans = (
        F.when(kind == "STRING", "evidence_quote must be a non-empty string").when(no_list, "evidence_quote must be a string or a list of strings")
        .when(F.size(F.try_variant_get("_v", "$.evidence_quote", "array<variant>")) == 0, "evidence_quote must not be an empty list").otherwise("evidence_quote spans must each be a non-empty string")
    )
    conflict = F.when(~o.there("conflict"), F.lit(False)).otherwise(o.boolean("conflict"))
    fields = {
        "source_id": o.text("source_id"), "chunk_id": o.text("chunk_id"), "sub_asset_raw": o.said("sub_asset_raw"), "sub_asset_class": o.text("sub_asset_class"), "taxonomy_match": o.text("taxonomy_match"),
        "call_view": o.text("view"), "call_language": language, "evidence_kind": o.text("evidence_kind"), "evidence_spans": spans, "locator": o.text("locator"), "reasoning": o.text("reasoning"),
        "conflict": conflict, "basis": basis, "delta_value": F.when(delta, o.number("delta_value")), "delta_unit": F.when(delta, o.text("delta_unit")),
    }
    absent = F.array_compact(F.array(*[F.when(~o.there(k), F.lit(k)) for k in ("delta_value", "delta_unit")]))
    one_absent = F.concat(F.lit("forecast_delta candidate requires "), F.get(absent, 0))
    wrong, first = _errors(
        [
            (F.size(missing) > 0, "missing_fields", F.concat(F.lit("candidate missing required fields: "), F.array_join(missing, ", "))),
            (~_in(basis, BASES), "basis", f"basis must be one of {', '.join(BASES)}"),
            (delta & (~o.there("delta_value") | ~o.there("delta_unit")), "delta_fields", one_absent),
            (delta & o.number("delta_value").isNull(), "delta_value", "delta_value must be a number"),
            (delta & ~_in(o.text("delta_unit"), UNITS), "delta_unit", _choice_check(o, "delta_unit", UNITS)[2]),
            *[_text_check(o, k) for k in ("source_id", "chunk_id", "sub_asset_class")],
            _choice_check(o, "taxonomy_match", MATCHES), _choice_check(o, "view", VIEWS), _choice_check(o, "call_language", LANGUAGES, language), _choice_check(o, "evidence_kind", KINDS),
            (bad_spans, "evidence_quote", about_spans), *[_text_check(o, k) for k in ("locator", "reasoning")], (conflict.isNull(), "conflict", "conflict must be a boolean"),
        ]
    )
    return o.drop(_with_errors(x, fields, wrong, first), asked)


def _with_errors(x: DataFrame, fields: dict, wrong: Column, first: Column) -> DataFrame:
    none = F.col("_v").isNull()
    checked = x.withColumn("_errors", F.when(none, F.array(F.lit("not_an_object"))).otherwise(wrong)).withColumn("_message", F.when(none, "response item must be a JSON object").otherwise(first))
    return checked.withColumns(fields).drop("errors", "message", "_v").withColumnsRenamed({"_errors": "errors", "_message": "message"})


def verdicts(df: DataFrame, text: str) -> DataFrame:
    o = _Object(F.col("_v"))
    x = parse_object(df, text)
    strength = F.when(o.null("evidence_strength"), "").otherwise(o.text("evidence_strength"))
    fields = {"cand_idx": o.whole("index"), **{q: o.text(q) for q in ("supports_view", "forward_looking", "asset_match")}, "evidence_strength": strength, "note": o.said("note")}
    wrong, first = _errors(
        [
            (~F.coalesce(o.whole("index") >= 0, F.lit(False)), "index", "verdict index must be a non-negative integer"),
            *[_choice_check(o, q, ANSWERS) for q in ("supports_view", "forward_looking", "asset_match")],
            (~o.null("evidence_strength") & ~_in(o.text("evidence_strength"), STRENGTHS), "evidence_strength", f"evidence_strength must be one of {', '.join(STRENGTHS)}"),
        ]
    )
    return _with_errors(x, fields, wrong, first)


def items(df: DataFrame, text: str, field: str) -> DataFrame:
    """df with item_no and item, the JSON of each element of the list in `field`; null item where there is no such list."""
    x = parse_object(df, text)
    listed = F.try_variant_get("_v", f"$.{field}", "array<variant>")
    return x.select(*df.columns, F.posexplode_outer(listed).alias("item_no", "_i")).withColumn("item", F.to_json("_i")).drop("_i")


def whole_responses(checked: DataFrame, response: list[str]) -> DataFrame:
    """response, valid: one bad item makes a whole response invalid."""
    return checked.groupBy(*response).agg(F.min(F.size("errors") == 0).alias("valid"), F.first(F.when(F.size("errors") > 0, F.col("errors")[0]), ignorenulls=True).alias("error"))


def first_valid_attempt(checked: DataFrame, response: list[str], attempt: str, most: int = 3) -> DataFrame:
    """response, attempt: the first attempt that is valid as a whole, of the first `most`; no row where none is."""
    valid = whole_responses(checked, [*response, attempt]).where(F.col("valid") & (F.col(attempt) <= most))
    return valid.groupBy(*response).agg(F.min(attempt).alias(attempt))


def last_verdicts(checked: DataFrame, counts: DataFrame, source: str, order: str) -> DataFrame:
    """One verdict for each candidate: indices out of range fall away, of repeated ones the last counts. counts(source, n)."""
    inside = checked.join(counts, source).where((F.col("cand_idx") >= 0) & (F.col("cand_idx") < F.col("n"))).drop("n")
    rest = [c for c in inside.columns if c not in (source, "cand_idx")]
    return inside.groupBy(source, "cand_idx").agg(F.max_by(F.struct(*rest), order).alias("_v")).select(source, "cand_idx", "_v.*")


def list_response(df: DataFrame, text: str, field: str, who: str = "response") -> DataFrame:
    """Adds summary and envelope_error: what is wrong with a response that must be an object with a list in `field`, or null."""
    x = parse_object(df, text)
    summary, error = _envelope(F.coalesce(F.startswith(_Object(F.col("_v")).kind(field), F.lit("ARRAY")), F.lit(False)), field, who)
    return x.withColumn("summary", summary).withColumn("envelope_error", error).drop("_v")


def _envelope(listed: Column, field: str, who: str) -> tuple[Column, Column]:
    """(summary, what is wrong) of a parsed response."""
    o = _Object(F.col("_v"))
    summary = F.when(~o.there("summary"), "").otherwise(o.text("summary"))
    return summary, F.when(F.col("_v").isNull(), f"{who} must be a JSON object").when(~listed, f"{who} must include a {field} list").when(summary.isNull(), f"{who} summary must be a string")


def list_items(df: DataFrame, text: str, field: str, keep: list[str], who: str = "response") -> DataFrame:
    """keep, envelope_error, item_no, item: the elements, as VARIANT, of each response's list; one row without them where it is empty or no list.

    The response is parsed once, and its text stays behind: an item has the columns of `keep` only.
    """
    x = parse_object(df, text).withColumn("_list", F.try_variant_get("_v", f"$.{field}", "array<variant>"))
    told = x.withColumn("envelope_error", _envelope(F.col("_list").isNotNull(), field, who)[1])
    return told.select(*keep, "envelope_error", F.posexplode_outer("_list").alias("item_no", "item"))


def group_plan(df: DataFrame, text: str) -> DataFrame:
    """Adds groups (array of source_ids and note), unmatched_notes and error, of a response that groups sources."""
    o = _Object(F.col("_v"))
    x = parse_object(df, text)
    raw = F.try_variant_get("_v", "$.groups", "array<variant>")
    kind = lambda g, key: F.coalesce(F.schema_of_variant(F.try_variant_get(g, f"$.{key}", "variant")), F.lit(""))
    ids = lambda g: F.try_variant_get(g, "$.source_ids", "array<string>")
    no_object = F.exists(raw, lambda g: ~F.startswith(F.schema_of_variant(g), F.lit("OBJECT")))
    bad_ids = F.exists(raw, lambda g: (kind(g, "source_ids") != "ARRAY<STRING>") | F.coalesce(F.size(ids(g)) < 2, F.lit(True)) | F.exists(ids(g), lambda i: _blank(i)))
    bad_note = F.exists(raw, lambda g: ~kind(g, "note").isin("", "STRING"))
    notes, notes_kind = F.try_variant_get("_v", "$.unmatched_notes", "array<string>"), o.kind("unmatched_notes")
    sure = lambda c: F.coalesce(c, F.lit(False))
    error = (
        F.when(F.col("_v").isNull(), "group resolver response must be a JSON object").when(~sure(F.startswith(o.kind("groups"), F.lit("ARRAY"))), "group resolver response must include a groups list")
        .when(sure(no_object), "each group must be a JSON object").when(sure(bad_ids), "each group needs source_ids: at least two source-id strings").when(sure(bad_note), "group note must be a string")
        .when(o.there("unmatched_notes") & ~sure(notes_kind.isin("ARRAY<STRING>", "ARRAY<VOID>")), "unmatched_notes must be a list of strings")
    )
    groups = F.transform(raw, lambda g: F.struct(ids(g).alias("source_ids"), F.coalesce(F.try_variant_get(g, "$.note", "string"), F.lit("")).alias("note")))
    return x.withColumn("groups", groups).withColumn("unmatched_notes", F.coalesce(notes, F.array().cast("array<string>"))).withColumn("error", error).drop("_v")


def arbitration(df: DataFrame, text: str) -> DataFrame:
    """Adds winning_index (null for none), reasoning and error, of a response that decides a conflict."""
    o = _Object(F.col("_v"))
    x = parse_object(df, text)
    bad_index = ~o.null("winning_index") & ~F.coalesce(o.whole("winning_index") >= 0, F.lit(False))
    error = (
        F.when(F.col("_v").isNull(), "arbiter response must be a JSON object")
        .when(bad_index, "winning_index must be a non-negative integer or null").when(_blank(o.text("reasoning")), "arbiter reasoning must be a non-empty string")
    )
    return x.withColumn("winning_index", o.whole("winning_index").try_cast("int")).withColumn("reasoning", o.text("reasoning")).withColumn("error", error).drop("_v")


def to_json(spans: str = "evidence_spans", basis: str = "basis") -> Column:
    """A candidate as JSON in the contract's order: one span as a text, several as a list; deltas only for forecast_delta."""
    head = F.to_json(F.struct("source_id", "chunk_id", "sub_asset_raw", "sub_asset_class", "taxonomy_match", F.col("call_view").alias("view"), "call_language", "evidence_kind"))
    one = F.when(F.size(spans) == 1, F.to_json(F.struct(F.col(spans)[0].alias("evidence_quote")))).otherwise(F.to_json(F.struct(F.col(spans).alias("evidence_quote"))))
    delta = F.col(basis) == "forecast_delta"
    rest = F.to_json(F.struct("locator", "reasoning", "conflict", basis, F.when(delta, F.col("delta_value")).alias("delta_value"), F.when(delta, F.col("delta_unit")).alias("delta_unit")))
    return F.concat(F.regexp_replace(head, r"\}$", ","), F.regexp_replace(F.regexp_replace(one, r"\}$", ","), r"^\{", ""), F.regexp_replace(rest, r"^\{", ""))
