"""Group operators: conflicts, same-view and cross-leaf duplicates, corroboration.

Candidates have an order (idx), which breaks ties. Windows are partitioned by the group and leaf; a hot group's rows
are first cut down by partial aggregation wherever only a winner is asked for. Null group keys form one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmill.common import join_same, stored
from callmill.functions.text import leaf_overlap, normalize_composed, normalize_spans


def view_conflicts(rows: DataFrame, keys: list[str], view: str = "call_view") -> DataFrame:
    """keys, views, conflict, members: whether a group holds more than one view. Pre-aggregates by view."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(view)).alias("views"), F.count("*").alias("members")).withColumn("conflict", F.size("views") > 1)


def same_view_winners(rows: DataFrame, keys: list[str], score: str, idx: str) -> DataFrame:
    """The best row of each group, the first where scores tie, by an aggregate that combines before the shuffle."""
    order = F.struct(F.coalesce(F.col(score).cast("double"), F.lit(float("-inf"))), -F.col(idx))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rows.columns if c not in keys]), order).alias("_best"), F.count("*").alias("members"))
    return best.select(*keys, "_best.*", "members")


def route_same_view(rows: DataFrame, keys: list[str], score: str, idx: str) -> DataFrame:
    """rows with reason (null for the winner, else duplicate_same_view) and the winner's idx.

    Winners come from the pre-aggregate, not from sorting whole groups, so a hot group is never in one task.
    """
    winners = same_view_winners(rows.select(*keys, score, idx), keys, score, idx).select(*keys, F.col(idx).alias("winner_idx"))
    return join_same(rows.drop("winner_idx"), winners, keys).withColumn("reason", F.when(F.col(idx) != F.col("winner_idx"), "duplicate_same_view"))


def group_index(rows: DataFrame, keys: list[str], idx: str, block: int = 100_000) -> DataFrame:
    """The row's place within its group, from 0. Null keys form a group.

    Rows are numbered within blocks of the order's range, and a block's numbers are shifted by how many of the group stand
    in earlier blocks, so that no task sorts more of a group than one block holds.
    """
    blocked = rows.withColumn("_block", F.floor(F.col(idx) / block))
    sizes = blocked.groupBy(*keys, "_block").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    local = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(idx)) - 1
    numbered = blocked.withColumn("_local", local)
    joined = join_same(numbered, shifts, [*keys, "_block"])
    return joined.withColumn("group_idx", (F.col("_local") + F.col("_before")).cast("int")).drop("_block", "_local", "_before")


def arbitrate(rows: DataFrame, keys: list[str], decisions: DataFrame, idx: str, view: str = "call_view") -> DataFrame:
    """Reason of each row of the groups with more than one view, by the decisions(keys, winning_index, reasoning).

    No or an impossible decision leaves all of the group unresolved; else all but the chosen are arbitrated out. Only
    conflicting groups are numbered. Null keys form a group.
    """
    conflicts = view_conflicts(rows, keys, view).where("conflict").select(*keys, "members")
    in_conflict = group_index(join_same(rows.drop("members"), conflicts, keys), keys, idx)
    decided = join_same(in_conflict.drop("winning_index", "reasoning"), decisions.select(*keys, F.col("winning_index"), "reasoning"), keys, "left")
    valid = F.col("winning_index").between(0, F.col("members") - 1)
    reason = F.when(~F.coalesce(valid, F.lit(False)), "unresolved_conflict").when(F.col("group_idx") != F.col("winning_index"), "arbitrated_out")
    return decided.withColumn("reason", reason)


def corroboration(rows: DataFrame, keys: list[str], score: str, idx: str, source: str, title: str, locator: str) -> DataFrame:
    """For each group's winner: "title (locator)" of the rows from other sources, in order, joined by semicolons. Null keys form a group.

    The list is the result's own text, as long as the companions of one group and leaf.
    """
    routed = route_same_view(rows, keys, score, idx)
    won = routed.where("reason is null").select(F.col(source).alias("_source"), F.col(idx).alias("winner_idx"))
    lost = routed.where("reason is not null").select(F.col("winner_idx").alias("_w"), F.col(source).alias("_other"), F.col(idx).alias("_i"), F.concat(F.coalesce(title, source), F.lit(" ("), F.coalesce(locator, F.lit("")), F.lit(")")).alias("note"))
    joined = lost.join(won, lost._w == won.winner_idx).where(~F.col("_source").eqNullSafe(F.col("_other")) & F.col("note").isNotNull())
    notes = F.transform(F.array_sort(F.collect_list(F.struct("_i", "note"))), lambda n: n["note"])
    said = joined.groupBy("winner_idx").agg(F.array_join(notes, "; ").alias("corroboration"))
    kept = routed.where("reason is null").select(*keys, F.col(idx).alias("winner_idx"))
    return kept.join(said, "winner_idx", "left").select(*keys, "winner_idx", F.coalesce("corroboration", F.lit("")).alias("corroboration"))


def display_sources(members: DataFrame, group: str, order: str, *fields: str) -> DataFrame:
    """group with each field of its members joined by " | " in order."""
    listed = F.array_sort(F.collect_list(F.struct(order, *[F.coalesce(f, F.lit("")).alias(f) for f in fields])))
    joined = lambda f: F.array_join(F.transform("_m", lambda m: m[f]), " | ").alias(f)
    return members.groupBy(group).agg(listed.alias("_m")).select(group, *map(joined, fields))


def span_key(normalized: Column) -> Column:
    """The set of normalised spans, whatever their order."""
    return F.array_sort(F.array_distinct(F.filter(normalized, lambda s: F.coalesce(s, F.lit("")) != "")))


def cross_leaf_duplicates(rows: DataFrame, source: str, view: str, spans: str, leaf: str, leaf_no: str, idx: str) -> DataFrame:
    """rows with reason and, where it is set, message: of the rows of one source, view and evidence, those whose leaf the
    evidence names are kept; where it names none, the one with the best overlap, then the least number. The message lists
    the leaves that were kept.

    Groups are known by a 256-bit digest of their key. Of a group only its kept leaves are listed, which differ from one
    another, so a list is as long as the taxonomy at most.
    """
    keyed = rows.withColumn("_norm", normalize_spans(F.col(spans))).withColumn("_key", F.sha2(F.to_json(F.struct(F.col(source).alias("s"), F.col(view).alias("v"), span_key(F.col("_norm")).alias("k"))), 256))
    # stored: the evidence is normalised once for both uses below
    scored = stored(keyed.withColumn("_overlap", leaf_overlap(F.col(leaf), normalize_composed(F.array_join("_norm", " ... ")))).drop("_norm"), "overlaps")
    order = F.struct(-F.col("_overlap"), F.coalesce(leaf_no, F.lit(2**31 - 1)), F.col(idx))
    best = scored.groupBy("_key").agg(
        F.count("*").alias("_n"), F.max(F.col("_overlap") > 0).alias("_named"), F.min(order).alias("_best"), F.min_by(F.col(leaf), order).alias("_best_leaf"),
    )
    kept = scored.where("_overlap > 0").groupBy("_key", leaf).agg(F.min(idx).alias("_i")).groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_i", F.col(leaf).alias("l")))).alias("_kept"))
    joined = scored.join(best.where("_n > 1"), "_key", "left").join(kept, "_key", "left")
    drop = F.coalesce(F.when(F.col("_named"), F.col("_overlap") == 0).otherwise(order != F.col("_best")), F.lit(False))
    quoted = lambda x: F.concat(F.lit("'"), F.coalesce(x, F.lit("")), F.lit("'"))
    said = F.when(F.col("_named"), F.array_join(F.transform("_kept", lambda k: quoted(k["l"])), ", ")).otherwise(quoted(F.col("_best_leaf")))
    message = F.concat(F.lit("same source, view, and evidence as kept leaf "), said, F.lit("; this leaf is not named in the shared evidence (cross-leaf fan-out)"))
    out = joined.withColumn("reason", F.when(drop & (F.col("_n") > 1), "duplicate_cross_leaf")).withColumn("message", F.when(F.col("reason").isNotNull(), message))
    return out.drop("_key", "_overlap", "_n", "_named", "_best", "_best_leaf", "_kept")


def rolling_memory(blocks: DataFrame, keys: list[str], order: str, block: str, head: str | None = None) -> DataFrame:
    """What each block of a source sees: the source's heading, where a column holds it, and all earlier blocks of it, in order.

    The memory is the result's own text: as long as what its source left so far.
    """
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("memory", F.concat(F.coalesce(head, F.lit("")) if head else F.lit(""), F.array_join(F.collect_list(block).over(earlier), "")))


def companion_memory(blocks: DataFrame, groups: DataFrame, source_order: str, order: str, block: str, head: str, preface: str) -> DataFrame:
    """As rolling_memory, where each source of a group begins with the whole memory of the one before it, after a preface.

    blocks(source_id, ..., head) has every source's heading on its rows; groups(source_id, group_id). Sources of no group
    stand alone. A memory that holds another ends it with a line break, so the headings stand in front in reverse order.
    """
    grouped = join_same(blocks.drop("group_id"), groups.select("source_id", "group_id"), ["source_id"], "left").withColumn("group_key", F.coalesce("group_id", "source_id"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.coalesce(block, F.lit("")).alias("b")))), lambda x: x["b"]), "")
    sources = grouped.groupBy("group_key", "source_id").agg(F.min(source_order).alias("_ord"), F.first(head).alias("_head"), body.alias("_body"))
    so_far = Window.partitionBy("group_key").orderBy("_ord", "source_id")
    placed = sources.withColumn("_k", F.row_number().over(so_far))
    heads = F.collect_list(F.when(F.col("_k") == 1, F.col("_head")).otherwise(F.concat("_head", F.lit(preface)))).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    bodies = F.collect_list(F.concat("_body", F.lit("\n"))).over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    begun = placed.select("source_id", F.concat(F.array_join(F.reverse(heads), ""), F.array_join(bodies, "")).alias("_start"))
    own = rolling_memory(grouped, ["group_key", "source_id"], order, block)
    return own.join(begun, "source_id").withColumn("memory", F.concat("_start", "memory")).drop("_start")
