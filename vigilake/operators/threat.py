"""ATT&CK lookups, kill-chain evidence, exact posteriors and threat assessments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.functions import scalars as S

STAGE_COUNT = len(kb.STAGES)


def _dimension(df: DataFrame) -> DataFrame:
    """The technique table; a fixed 29 rows, hence safe to broadcast whatever the fact side's size."""
    return F.broadcast(kb.techniques_table(df.sparkSession))


def add_technique_info(df: DataFrame, column: str = "technique_id") -> DataFrame:
    """Name, tactic, description and kill-chain index of a technique; unknown ids get defaults and -1."""
    dim = _dimension(df).withColumnRenamed("technique_id", "__id")
    joined = df.join(dim, F.col(column) == F.col("__id"), "left").drop("__id")
    missing = F.concat(F.lit("Technique "), F.coalesce(F.col(column), F.lit("None")), F.lit(" not in database"))
    return joined.withColumns({
        "technique_name": F.coalesce("technique_name", F.lit("Unknown")),
        "tactic": F.coalesce("tactic", F.lit("unknown")),
        "description": F.coalesce("description", missing),
        "stage_idx": F.coalesce("stage_idx", F.lit(-1)),
    })


def _expand(df: DataFrame, column: str, table: dict[str, list[str]]) -> DataFrame:
    """One row per technique mapped to the value, numbered from 0; unmapped values give no rows."""
    pairs = []
    for key, ids in table.items():
        if ids:
            pairs += [F.lit(key), F.array(*[F.lit(i) for i in ids])]
    ids = F.try_element_at(F.create_map(*pairs), F.col(column))
    return add_technique_info(df.select("*", F.posexplode(ids).alias("position", "technique_id")))


def techniques_of_event_type(df: DataFrame, column: str = "event_type") -> DataFrame:
    return _expand(df, column, kb.EVENT_TYPE_TECHNIQUES)


def techniques_of_label(df: DataFrame, column: str = "label") -> DataFrame:
    return _expand(df, column, kb.LABEL_TECHNIQUES)


def stage_index(stage: Column) -> Column:
    """0..8 for a tactic name, -1 otherwise."""
    return F.coalesce(F.array_position(F.array(*[F.lit(s) for s in kb.STAGES]), stage) - 1, F.lit(-1)).cast("int")


# --- evidence -----------------------------------------------------------------------------
def stages_of_mask(mask: Column) -> Column:
    """The stage names whose bits are set, in kill-chain order."""
    stages = F.array(*[F.lit(s) for s in kb.STAGES])
    return F.filter(stages, lambda s, i: mask.bitwiseAND(F.call_function("shiftleft", F.lit(1), i)) != 0)


def evidence_by_entity(observations: DataFrame, keys: Sequence[str], stage: str = "tactic",
                       value: str | None = None) -> DataFrame:
    """Evidence per entity as two 9-bit masks: ``seen_mask`` (stages with evidence) and ``value_mask`` (value 1).

    Bit masks merge before the shuffle and never grow. Stage names outside the kill chain do not count as
    evidence; ``unknown_stages`` says how many there were.
    """
    index = stage_index(F.col(stage))
    bit = F.when(index >= 0, F.call_function("shiftleft", F.lit(1), index)).otherwise(0)
    positive = bit if value is None else F.when(F.col(value) == 1, bit).otherwise(0)
    return observations.groupBy(*keys).agg(
        F.bit_or(bit).alias("seen_mask"),
        F.bit_or(positive).alias("value_mask"),
        F.count_if(index < 0).alias("unknown_stages"),
    )


def observed_stages(events: DataFrame, keys: Sequence[str] = ("pod",), column: str = "mitre_technique") -> DataFrame:
    """Evidence masks per entity from the techniques its events carry (entities without any are kept)."""
    tagged = add_technique_info(events.select(*keys, F.col(column).alias("technique_id")))
    return evidence_by_entity(tagged, keys).withColumn("observed_stages", stages_of_mask(F.col("value_mask")))


# --- posteriors ---------------------------------------------------------------------------
def _bit(state: Column, stage: str) -> Column:
    return F.shiftright(state, kb.STAGES.index(stage)).bitwiseAND(F.lit(1))


def joint_probability(state: Column) -> Column:
    """P(all nine stages) of a state given as a 9-bit number: the product of the conditional probabilities."""
    product = F.lit(1.0)
    for stage, (parents, active) in kb.STAGE_PROBABILITIES.items():
        row = F.lit(0)
        for parent in parents:
            row = row * 2 + _bit(state, parent)
        p_active = F.element_at(F.array(*[F.lit(p) for p in active]), (row + 1).cast("int"))
        product = product * F.when(_bit(state, stage) == 1, p_active).otherwise(F.lit(1.0) - p_active)
    return product


def posteriors(evidence: DataFrame) -> DataFrame:
    """P(stage = 1 | evidence) by enumeration, one row per distinct (seen_mask, value_mask) and stage.

    There are at most 3^9 distinct evidence patterns however many entities there are. Each is expanded to the
    states it allows and summed, so no join is involved.
    """
    patterns = evidence.select("seen_mask", "value_mask").distinct()
    states = patterns.select("*", F.explode(F.sequence(F.lit(0), F.lit(2**STAGE_COUNT - 1))).alias("state"))
    allowed = states.filter(F.col("state").bitwiseAND(F.col("seen_mask")) == F.col("value_mask"))
    weighted = allowed.withColumn("p", joint_probability(F.col("state")))
    sums = weighted.groupBy("seen_mask", "value_mask").agg(
        F.sum("p").alias("total"),
        *[F.sum(F.when(_bit(F.col("state"), s) == 1, F.col("p")).otherwise(0.0)).alias(s) for s in kb.STAGES],
    )
    rows = F.array(*[
        F.struct(F.lit(i).alias("stage_idx"), F.lit(s).alias("stage"), (F.col(s) / F.col("total")).alias("probability"))
        for i, s in enumerate(kb.STAGES)
    ])
    return sums.select("seen_mask", "value_mask", F.explode(rows).alias("r")).select("seen_mask", "value_mask", "r.*")


def _unobserved(seen: Column, index: Column) -> Column:
    return seen.bitwiseAND(F.call_function("shiftleft", F.lit(1), index)) == 0


def ranked_predictions(evidence: DataFrame) -> DataFrame:
    """Per evidence pattern: its unobserved stages, most probable first, as an array of at most nine structs."""
    open_stages = posteriors(evidence).filter(_unobserved(F.col("seen_mask"), F.col("stage_idx")))
    entry = F.struct((-F.round("probability", 12)).alias("o"), "stage_idx", "stage", "probability")
    ranked = open_stages.groupBy("seen_mask", "value_mask").agg(F.array_sort(F.collect_list(entry)).alias("r"))
    slim = F.transform("r", lambda e: F.struct(e["stage"].alias("stage"), e["probability"].alias("probability")))
    return ranked.select("seen_mask", "value_mask", slim.alias("predictions"))


def predict_next_stage(evidence: DataFrame) -> DataFrame:
    """One row per entity and unobserved stage with its posterior and rank (1 = most probable)."""
    return _attach(evidence, ranked_predictions(evidence), "left").select(
        *evidence.columns, F.posexplode("predictions").alias("__pos", "p")
    ).select(*evidence.columns, "p.stage", "p.probability", (F.col("__pos") + 1).alias("rank"))


def _attach(evidence: DataFrame, by_pattern: DataFrame, how: str) -> DataFrame:
    # at most 3^9 = 19 683 pattern rows: a proven bound, whatever the number of entities
    return evidence.join(F.broadcast(by_pattern), ["seen_mask", "value_mask"], how)


def deepest_stage(mask: Column) -> Column:
    """Index of the highest set bit, -1 for none."""
    deepest = F.lit(-1)
    for i in range(STAGE_COUNT):
        deepest = F.when(F.shiftright(mask, i).bitwiseAND(F.lit(1)) == 1, i).otherwise(deepest)
    return deepest


def heuristic_predictions(evidence: DataFrame) -> DataFrame:
    """Distance-based scores used where no probabilities are available; same shape as ``predict_next_stage``."""
    stages = F.array(*[F.lit(s) for s in kb.STAGES])
    # array order: probability descending, then kill-chain order
    scored = F.transform(
        F.filter(F.transform(stages, lambda s, i: F.struct(i.alias("i"), s.alias("stage"))),
                 lambda e: _unobserved(F.col("seen_mask"), e["i"])),
        lambda e: F.struct(
            (-_heuristic(e["i"])).alias("o"), e["i"].alias("i"), e["stage"].alias("stage"),
            _heuristic(e["i"]).alias("probability")),
    )
    with_depth = evidence.withColumn("__deepest", deepest_stage(F.col("value_mask")))
    ranked = with_depth.select(*evidence.columns, F.posexplode(F.array_sort(scored)).alias("__pos", "p"))
    return ranked.select(*evidence.columns, "p.stage", "p.probability", (F.col("__pos") + 1).alias("rank"))


def _heuristic(index: Column) -> Column:
    gap = index - F.col("__deepest") - 1
    later = F.greatest(F.lit(0.1), F.lit(0.8) - F.lit(0.15) * gap)
    return F.when(gap == 0, F.lit(0.8)).when(gap > 0, later).otherwise(F.lit(0.1))


# --- assessment ---------------------------------------------------------------------------
def risk_of_stage(deepest: Column) -> Column:
    return S.first_match([(deepest >= low, risk) for low, risk in kb.STAGE_RISK], "LOW")


def all_pattern_predictions(spark: SparkSession) -> DataFrame:
    """Ranked predictions of all 512 evidence patterns without negative evidence, e.g. to join to a stream."""
    patterns = spark.range(2**STAGE_COUNT).select(
        F.col("id").cast("int").alias("seen_mask"), F.col("id").cast("int").alias("value_mask")
    )
    return ranked_predictions(patterns)


def assess(evidence: DataFrame, top: int = 3, by_pattern: DataFrame | None = None) -> DataFrame:
    """Progression, risk level, the ``top`` most probable next stages and the recommended action per entity."""
    deepest = deepest_stage(F.col("value_mask"))
    attached = _attach(evidence, ranked_predictions(evidence) if by_pattern is None else by_pattern, "left")
    progression = F.concat((F.col("deepest_idx") + 1).cast("string"), F.lit(f"/{STAGE_COUNT} stages"))
    nothing = F.array().cast("array<struct<stage:string,probability:double>>")
    return attached.withColumn("deepest_idx", deepest).withColumn("risk_level", risk_of_stage(F.col("deepest_idx"))).select(
        *evidence.columns,
        stages_of_mask(F.col("value_mask")).alias("stages"),
        "deepest_idx",
        progression.alias("attack_progression"),
        "risk_level",
        F.slice(F.coalesce("predictions", nothing), 1, top).alias("predictions"),
        S.lookup(F.col("risk_level"), kb.RISK_RECOMMENDATION, "Continue monitoring").alias("recommended_action"),
    )
