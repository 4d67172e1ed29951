"""Decision sources: recorded decisions replayed as a table, or an injected callable run beside the data.

An engine takes a prompt and gives text. It runs inside mapInPandas, a prompt at a time and with bounded repairs; the
decisions land in a table keyed like the recorded ones, so everything after it is the same for both.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmill.common import join_same, stored
from callmill.operators import contracts
from callmill.operators.assemble import group_index

Engine = Callable[[str], str]
#: Says what is wrong with a response, or None.
Validator = Callable[[str], str | None]


@dataclass(frozen=True)
class Rule:
    """How an engine is called: its command, the efforts it knows, a model it is bound to, and how both are told."""

    prefix: tuple[str, ...]
    efforts: tuple[str, ...] = ()
    model: str | None = None
    needs_model: bool = False
    model_flags: tuple[str, ...] = ("--model", "{}")
    effort_flags: tuple[str, ...] = ("--effort", "{}")


@dataclass(frozen=True)
class Settings:
    """An engine's name, model and effort, and what each engine allows."""

    engine: str
    model: str | None = None
    effort: str | None = None
    repairs: int = 2

    def checked(self, allowed: dict[str, Rule]) -> Settings:
        if self.engine not in allowed:
            raise ValueError(f"unknown engine {self.engine}; expected one of {', '.join(sorted(allowed))}")
        rule = allowed[self.engine]
        if rule.model and self.model not in (None, rule.model):
            raise ValueError(f"{self.engine} runs {rule.model} only, not {self.model}")
        if self.effort is not None and self.effort not in rule.efforts:
            raise ValueError(f"{self.engine} has no effort {self.effort}; expected one of {', '.join(rule.efforts)}")
        if rule.needs_model and not self.model:
            raise ValueError(f"{self.engine} needs a model")
        return self

    def argv(self, allowed: dict[str, Rule], prompt: str) -> list[str]:
        """The command's arguments, the prompt last; a bound model is always told."""
        rule = self.checked(allowed)._rule(allowed)
        told = [(rule.model or self.model, rule.model_flags), (self.effort, rule.effort_flags)]
        return [*rule.prefix, *(flag.format(value) for value, flags in told if value is not None for flag in flags), prompt]

    def _rule(self, allowed: dict[str, Rule]) -> Rule:
        return allowed[self.engine]


def _sorted_json(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True)


def compose_prompt(base: str, inputs: str | None) -> str:
    """A prompt with its inputs (JSON) under a heading, their keys in order."""
    return base if inputs is None else f"{base.rstrip()}\n\n## Machine-readable inputs\n{_sorted_json(json.loads(inputs))}\n"


def repair_prompt(base: str, inputs: str | None, previous: str, error: str) -> str:
    """The prompt that follows a response which broke the contract."""
    told = {"original_inputs": json.loads(inputs) if inputs else {}, "validation_error": error, "previous_response": previous}
    return f"{base.rstrip()}\n\nThe previous response did not satisfy the JSON contract. Return only corrected JSON.\n\n{_sorted_json(told)}\n"


def attempts_of(engine: Engine, validate: Validator, base: str, inputs: str | None, repairs: int) -> Iterator[tuple[int, str | None, str | None]]:
    """(attempt, response, error) of each attempt; at most 1 + repairs. An error that the engine raises ends them."""
    asked = compose_prompt(base, inputs)
    for n in range(1, repairs + 2):
        try:
            answer = engine(asked)
        except Exception as e:  # noqa: BLE001
            yield n, None, f"engine_error: {e}"[:300]
            return
        error = validate(answer)
        yield n, answer, error
        if error is None:
            return
        asked = repair_prompt(base, inputs, answer, error)


def run_engine(prompts: DataFrame, keys: list[str], prompt: str, engine: Engine, validate: Validator, repairs: int = 2, inputs: str | None = None) -> DataFrame:
    """keys, attempt, response, error of every attempt; at most 1 + repairs for a prompt. inputs: a column of JSON."""
    chosen = prompts.select(*keys, F.col(prompt).alias("_prompt"), (F.col(inputs) if inputs else F.lit(None).cast("string")).alias("_inputs"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.select(*keys).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*row[:-2], *a) for row in batch.itertuples(index=False) for a in attempts_of(engine, validate, row[-2], row[-1], repairs)]
            yield pd.DataFrame(rows, columns=[*keys, "attempt", "response", "error"])

    return chosen.mapInPandas(run, f"{fields}, attempt int, response string, error string")


def accepted(attempts: DataFrame, keys: list[str], most: int = 3) -> DataFrame:
    """The first attempt without error of each key, of the first `most`."""
    good = attempts.where(F.col("error").isNull() & (F.col("attempt") <= most))
    return good.groupBy(*keys).agg(F.min_by("response", "attempt").alias("response"), F.min("attempt").alias("attempt"))


def exhausted(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys without a good attempt, with the last one's error: a failure record each."""
    last = attempts.groupBy(*keys).agg(F.max_by("error", "attempt").alias("message"), F.min(F.col("error").isNotNull()).alias("all_bad"))
    code = F.when(F.startswith("message", F.lit("engine_error")), "engine_error").otherwise("json_parse_error")
    return last.where("all_bad").select(*keys, code.alias("reason_code"), F.substring("message", 1, 300).alias("message"))


def memory_header(firm: Column, title: Column, source: Column) -> Column:
    """The first line of a source's memory."""
    return F.concat(F.lit("# "), F.coalesce(firm, F.lit("")), F.lit(" — "), F.coalesce(title, F.lit("")), F.lit("  ("), source, F.lit(")\n"))


def memory_block(chunk: Column, summary: Column, ledger: Column, failure: Column) -> Column:
    """What a chunk leaves to the later ones: its summary and its calls as leaf=view[locator], or that it was skipped and why."""
    text = lambda x: F.coalesce(x, F.lit(""))
    calls = F.array_join(F.transform(ledger, lambda c: F.concat(text(c["leaf"]), F.lit("="), text(c["call_view"]), F.lit("["), text(c["locator"]), F.lit("]"))), "; ")
    said = F.when(failure.isNotNull(), F.concat(F.lit("("), failure, F.lit("; chunk skipped)"))).otherwise(text(summary))
    listed = F.when(failure.isNotNull(), "none").otherwise(F.coalesce(F.nullif(calls, F.lit("")), F.lit("none")))
    return F.concat(F.lit("\n## Chunk "), chunk, F.lit("\nSummary: "), said, F.lit("\nCandidates: "), listed, F.lit("\n"))


# Fixed value: what stands between a document's heading and its companion's memory.
COMPANION = """
## Companion document already analyzed in this grouped source set
Report this document's own stances normally — corroboration and
conflicts across the set are resolved downstream; mark `conflict:
true` where this document disagrees with the companion.

"""


def analyze(chunks: DataFrame, template: str, engine: Engine, validate: Validator, constants: dict[str, str] | None = None, repairs: int = 2) -> DataFrame:
    """Reads chunks one after the other, each with what the earlier ones of its group left.

    chunks(group_key, source_ord, source_id, firm, title, chunk_ord, chunk_id, content) -> group_key, source_id, chunk_ord,
    chunk_id, attempt, response, reason_code, message, memory (what the chunk was read with). A chunk that fails leaves a
    line in the memory and stops nothing. A group is read in order by its nature; it comes to its task as a stream and is
    not gathered, only its memory is held.
    """
    names = ("group_key", "source_ord", "source_id", "firm", "title", "chunk_ord", "chunk_id", "content")

    def calls(answer: str) -> tuple[str, str]:
        said = json.loads(unfenced(answer))
        listed = "; ".join(f"{c.get('sub_asset_class')}={c.get('view')}[{c.get('locator')}]" for c in said.get("candidates", ()))
        return said.get("summary", ""), listed or "none"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, source, memory = None, None, ""
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if r.group_key != group:
                    group, source, seed = r.group_key, None, ""
                elif r.source_id != source:
                    seed = f"{COMPANION}{memory}\n"
                if r.source_id != source:
                    source, memory = r.source_id, f"# {r.firm or ''} — {r.title or ''}  ({r.source_id})\n{seed}"
                base = template
                for key, value in {**(constants or {}), "memory": memory, "chunk_content": r.content or ""}.items():
                    base = base.replace("{{" + key + "}}", value)
                inputs = json.dumps({"source_id": r.source_id, "chunk_id": r.chunk_id})
                *_, (attempt, answer, error) = attempts_of(engine, validate, base, inputs, repairs)
                reason = None if error is None else "engine_error" if answer is None else "json_parse_error"
                rows.append((r.group_key, r.source_id, r.chunk_ord, r.chunk_id, attempt, None if error else answer, reason, error and error[:300], memory))
                summary, listed = (f"({reason}; chunk skipped)", "none") if reason else calls(answer)
                memory += f"\n## Chunk {r.chunk_id}\nSummary: {summary}\nCandidates: {listed}\n"
            yield pd.DataFrame(rows, columns=["group_key", "source_id", "chunk_ord", "chunk_id", "attempt", "response", "reason_code", "message", "memory"])

    ordered = chunks.select(*names).repartition("group_key").sortWithinPartitions("group_key", "source_ord", "source_id", "chunk_ord")
    return ordered.mapInPandas(run, "group_key string, source_id string, chunk_ord int, chunk_id string, attempt int, response string, reason_code string, message string, memory string")


def unfenced(answer: str) -> str:
    """A response without a code fence around it."""
    lines = answer.strip().splitlines()
    if lines and lines[0].startswith("```"):
        lines = lines[1:-1] if lines[-1].startswith("```") and len(lines) > 1 else lines[1:]
    return "\n".join(lines).strip()


def responses_to_candidates(responses: DataFrame, keys: list[str], text: str, part: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(candidates, failures): the observations of recorded responses in their order, and the responses that break the contract.

    One bad observation makes its whole response fail, with the first one's message. keys name a response: source_id, chunk_id.
    A response may come in parts, each of them a response by contract: `part` orders them. Observations leave their
    response's text behind, so that what is held and written grows with the texts and not with texts times observations.
    """
    said = responses.select(*keys, (F.col(part) if part else F.lit(0)).alias("_part"), F.col(text).alias("_answer"))
    parted = contracts.list_items(said, "_answer", "candidates", [*keys, "_part"], "LLM response")
    told = parted.where("item is not null or envelope_error is not null").withColumnsRenamed({k: f"_{k}" for k in keys})
    checked = stored(contracts.candidates(told, "item").drop("item").withColumnsRenamed({f"_{k}": f"response_{k}" for k in keys}), "checked")
    marks = [f"response_{k}" for k in keys]
    wrong = checked.where(F.col("envelope_error").isNotNull() | (F.size("errors") > 0))
    bad = wrong.groupBy(*marks).agg(F.min_by(F.coalesce("envelope_error", "message"), F.struct("_part", "item_no")).alias("message"))
    kept = join_same(checked, bad.withColumn("_bad", F.lit(True)).drop("message"), marks, "left").where("_bad is null").drop("_bad", "errors", "message", "envelope_error")
    kept = kept.withColumnRenamed("_part", part) if part else kept.drop("_part")
    lost = bad.withColumnsRenamed(dict(zip(marks, keys)))
    return kept, lost.select(*keys, F.lit("json_parse_error").alias("reason_code"), F.substring(F.concat(F.lit("invalid LLM JSON after repair attempts: "), "message"), 1, 300).alias("message"))


def check_batches(rows: DataFrame, source: str, idx: str, *fields: str) -> DataFrame:
    """source, batch, n: one batch of candidates for each source that has any, their fields as JSON, in order, with indices from 0.

    A batch is one request by contract and as long as its source's candidates; their places are found in blocks.
    """
    local = group_index(rows.select(source, idx, *fields), [source], idx)
    return local.groupBy(source).agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("group_idx").alias("index"), *fields)))).alias("batch"), F.count("*").alias("n"))


def checked_verdicts(rows: DataFrame, responses: DataFrame, text: str = "response", error: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(verdicts, failures) of candidates rows(source_id, cand_idx) by responses(source_id, text), one for each source.

    Verdicts name candidates by their place in the source's batch; those out of range fall away and of repeated ones the
    last counts. A response that fails as a whole, or whose `error` is set, gives no verdict and one failure under the
    chunk "checker": the source's candidates then miss their check.
    """
    places = stored(group_index(rows.select("source_id", "cand_idx"), ["source_id"], "cand_idx"), "places")
    said = responses.select("source_id", F.col(text).alias("_answer"), (F.col(error) if error else F.lit(None).cast("string")).alias("_error"))
    opened = contracts.list_response(said, "_answer", "verdicts", "checker response").withColumn("_why", F.coalesce("_error", "envelope_error"))
    parted = contracts.items(opened.where("_why is null").select("source_id", "_answer"), "_answer", "verdicts").where("item is not null")
    checked = stored(contracts.verdicts(parted, "item"), "checked_verdicts")
    bad = checked.where(F.size("errors") > 0).groupBy("source_id").agg(F.min_by("message", "item_no").alias("message"))
    good = checked.join(bad.select("source_id"), "source_id", "left_anti")
    last = good.groupBy("source_id", F.col("cand_idx").alias("group_idx")).agg(F.max_by(F.struct("supports_view", "forward_looking", "asset_match", "evidence_strength", "note"), "item_no").alias("v"))
    found = places.join(last.withColumn("group_idx", F.col("group_idx").cast("int")), ["source_id", "group_idx"]).select("cand_idx", "v.*")
    lost = bad.unionByName(opened.where("_why is not null").select("source_id", F.col("_why").alias("message")))
    return found, lost.select("source_id", F.lit("checker").alias("chunk_id"), F.lit("checker_error").alias("reason_code"), F.substring("message", 1, 300).alias("message"))


def decided(conflicts: DataFrame, keys: list[str], responses: DataFrame, text: str = "response", error: str | None = None) -> DataFrame:
    """keys, winning_index, reasoning of conflicting groups by recorded responses(keys, text); a failed one decides nothing and says why."""
    said = contracts.arbitration(responses.select(*keys, F.col(text).alias("_answer"), (F.col(error) if error else F.lit(None).cast("string")).alias("_error")), "_answer").withColumn("_why", F.coalesce("_error", "error"))
    told = said.select(*keys, F.when(F.col("_why").isNull(), F.col("winning_index")).alias("winning_index"), F.when(F.col("_why").isNull(), F.col("reasoning")).otherwise(F.concat(F.lit("arbiter error: "), F.substring("_why", 1, 200))).alias("reasoning"))
    return join_same(told, conflicts.select(*keys).distinct(), keys)
