"""Deterministic verification of claims against evidence, and the answer's disposition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checked_citations(citations: DataFrame, evidence: DataFrame, layers: DataFrame) -> DataFrame:
    """Citations (claim_id, evidence_id, as_of, stance) with what holds of each: the evidence exists, its quote is in
    its layer at its offsets, its document is in force on the claim's day."""
    rows = citations.join(evidence, "evidence_id", "left").join(layers, "layer_id", "left")
    quoted = F.sha2(F.col("text").substr(F.col("start") + 1, F.col("end") - F.col("start")), 256) == F.col("quote_hash")
    in_force = (F.col("valid_from") <= F.col("as_of")) & (F.col("valid_to").isNull() | (F.col("as_of") < F.col("valid_to")))
    return rows.select("claim_id", "evidence_id", "stance", F.coalesce(quoted, F.lit(False)).alias("quoted"), F.col("valid_from").isNotNull().alias("dated"), F.coalesce(in_force, F.lit(False)).alias("in_force"))


def claim_states(claims: DataFrame, checked: DataFrame) -> DataFrame:
    """(claim_id, state): what its sound citations say together; the order of citations does not matter."""
    sound = F.col("quoted") & F.col("in_force")
    votes = checked.groupBy("claim_id").agg(
        F.count_if(sound & (F.col("stance") == "SUPPORTS")).alias("supports"),
        F.count_if(sound & (F.col("stance") == "PARTIAL")).alias("partial"),
        F.count_if(sound & (F.col("stance") == "CONTRADICTS")).alias("contradicts"),
        F.count_if(F.col("quoted") & ~F.col("dated")).alias("undated"),
    )
    state = (
        F.when(F.col("contradicts") > 0, "CONTRADICTED")
        .when(F.col("supports") > 0, "SUPPORTED")
        .when(F.col("partial") > 0, "PARTIALLY_SUPPORTED")
        .when(F.col("undated") > 0, "TEMPORALLY_AMBIGUOUS")
        .otherwise("INSUFFICIENT_EVIDENCE")
    )
    return claims.join(votes, "claim_id", "left").select(*claims.columns, state.alias("state"))


def lowered(state, model_state):
    """A model's verdict may lower a state and never raise it."""
    order = F.array(*map(F.lit, ("CONTRADICTED", "INSUFFICIENT_EVIDENCE", "TEMPORALLY_AMBIGUOUS", "PARTIALLY_SUPPORTED", "SUPPORTED")))
    return F.when(F.array_position(order, model_state) < F.array_position(order, state), model_state).otherwise(state)


def dispositions(states: DataFrame) -> DataFrame:
    """(answer_id, disposition) of the states of an answer's claims."""
    good = F.count_if(F.col("state") == "SUPPORTED")
    some = F.count_if(F.col("state").isin("SUPPORTED", "PARTIALLY_SUPPORTED"))
    return states.groupBy("answer_id").agg(F.when(good == F.count("*"), "ANSWERED").when(some > 0, "PARTIALLY_ANSWERED").otherwise("ABSTAINED").alias("disposition"))


def hard_filtered(chunks: DataFrame, applicable: DataFrame, **equal) -> DataFrame:
    """Chunks that pass every filter before any ranking: columns equal to a value or, for a pair, between both ends, and a
    version that applies on the day."""
    for column, value in equal.items():
        chunks = chunks.filter(F.col(column).between(*value) if isinstance(value, tuple) else F.col(column) == value)
    return chunks.join(applicable.select("version_id").distinct(), "version_id", "left_semi")
