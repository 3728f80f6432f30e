"""Standard concepts: chains of replaced and mapped concepts followed to their ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.operators.concepts import NO_CONCEPT
from clinspark.staging import Stage, Staging, lazily

# Relationships that lead to a standard concept, the preferred one first, and the flag of a standard concept.
FOLLOWED = ("Maps to", "Concept replaced by")
STANDARD = "S"

# The event table of a concept's domain.
DOMAIN_TARGETS = {
    "Condition": "condition_occurrence",
    "Drug": "drug_exposure",
    "Procedure": "procedure_occurrence",
    "Measurement": "measurement",
    "Device": "device_exposure",
    "Observation": "observation",
}

#: What became of a concept: it is standard itself, leads to one, ends elsewhere, or runs into a cycle.
STATES = ("standard", "mapped", "no standard", "cycle")


def is_valid(reason: str = "invalid_reason") -> Column:
    """Whether a vocabulary row has no reason to be invalid."""
    return F.coalesce(F.trim(reason), F.lit("")) == ""


def _is_standard() -> Column:
    return is_valid() & (F.coalesce("standard_concept", F.lit("")) == STANDARD)


def next_concepts(concept: DataFrame, relationship: DataFrame, kinds: Sequence[str] = FOLLOWED) -> DataFrame:
    """``node, next``: the one valid relationship that a concept is followed by.

    Earlier ``kinds`` come first, then targets that are standard, then the smallest target. A valid standard concept is an
    end and has no next; relationships of a concept with itself lead nowhere. Ends are merged, never a broadcast: their size
    is guessed from the files, and they may be millions.
    """
    rank = F.coalesce(*[F.when(F.col("relationship_id") == kind, i) for i, kind in enumerate(kinds)])
    links = relationship.where(is_valid() & F.col("relationship_id").isin(*kinds)).select(
        F.col("concept_id_1").alias("node"), F.col("concept_id_2").alias("next"), rank.alias("_rank"))
    links = links.where(F.col("node") != F.col("next"))  # nulls go, too
    ends = concept.where(_is_standard()).select(F.col("concept_id").alias("_end")).distinct().hint("merge")
    links = links.join(ends, F.col("next") == F.col("_end"), "left").select(
        "node", "next", "_rank", F.col("_end").isNull().alias("_other"))
    # Nodes come last, so that the aggregate finds its rows where they are.
    links = links.join(ends, F.col("node") == F.col("_end"), "left_anti")
    best = F.min(F.struct("_rank", "_other", "next"))
    return links.groupBy("node").agg(best.alias("_best")).select("node", F.col("_best.next").alias("next"))


def follow_to_end(links: DataFrame, staging: Staging) -> DataFrame:
    """``node, end, n_steps`` for every node of ``node, next``; the end of a chain into a cycle is null.

    Every round each node takes over the pointer of the node it points to, so paths double and the number of rounds is
    the logarithm of the longest chain. Nodes whose pointer still leads on become fewer every round, as a chain holds
    nodes of all lengths up to its own; when their number stays, all that are left lead into cycles. Each round is a
    stored table and one join, of which the side of the pointers has one row for a node; it is hashed where it was
    shuffled, since as a broadcast all pointers would pass the driver in each round.
    """
    pointers = staging.table(links.select("node", "next", F.lit(1).cast("bigint").alias("n_steps")))
    done, before = [], -1
    while True:
        onward = pointers.select(F.col("node").alias("_at"), F.col("next").alias("_next"), F.col("n_steps").alias("_more"))
        onward = onward.hint("shuffle_hash")
        stepped = staging.table(pointers.join(onward, F.col("next") == F.col("_at"), "left").select(
            "node", F.coalesce("_next", "next").alias("next"),
            (F.col("n_steps") + F.coalesce("_more", F.lit(0))).alias("n_steps"), F.col("_at").isNotNull().alias("_on")))
        live = stepped.where("_on").count()
        if live in (0, before):
            break
        before, pointers = live, stepped.drop("_on")
    return stepped.select("node", F.when(~F.col("_on"), F.col("next")).alias("end"), F.when(~F.col("_on"), F.col("n_steps")).alias("n_steps"))


def concept_targets(
    concept: DataFrame, relationship: DataFrame, staging: Staging, *, kinds: Sequence[str] = FOLLOWED
) -> DataFrame:
    """``concept_id, target_id, n_steps, state`` of every concept; ``target_id`` is null unless it is a valid standard concept."""
    ends = follow_to_end(next_concepts(concept, relationship, kinds), staging)
    flags = staging.table(concept.where(F.col("concept_id").isNotNull()).groupBy("concept_id").agg(
        F.max(_is_standard()).alias("_standard")))
    followed = flags.join(ends.hint("shuffle_hash"), F.col("concept_id") == F.col("node"), "left")
    followed = followed.withColumn("_last", F.when(F.col("node").isNull(), F.col("concept_id")).otherwise(F.col("end")))
    good = flags.where("_standard").select(F.col("concept_id").alias("_good"))
    found = followed.join(good.hint("merge"), F.col("_last") == F.col("_good"), "left")
    state = (
        F.when(F.col("node").isNotNull() & F.col("end").isNull(), "cycle").when(F.col("_good").isNull(), "no standard")
        .when(F.col("node").isNull(), "standard").otherwise("mapped")
    )
    steps = F.when(F.col("node").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("n_steps"))
    return found.select("concept_id", F.col("_good").alias("target_id"), steps.alias("n_steps"), state.alias("state"))


def concept_lookup(concept: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per (vocabulary, code): its own concept, the standard one (0 if none) and that one's domain.

    Of several concepts with one code the valid ones come first, then those that lead to a standard concept, then the
    smallest id. A target's domain joins the narrow targets, not the codes; both sides of either join have a row for a
    concept and are merged, since as a broadcast the vocabulary would pass the driver.
    """
    codes = concept.where(F.col("concept_id").isNotNull()).select(
        F.col("vocabulary_id").alias("vocab"), F.col("concept_code").alias("code"), "concept_id", (~is_valid()).alias("_invalid"))
    domains = concept.groupBy(F.col("concept_id").alias("_target")).agg(F.min("domain_id").alias("domain_id"))
    reached = targets.select(F.col("concept_id").alias("_of"), "target_id").join(
        domains.hint("merge"), F.col("target_id") == F.col("_target"), "left").drop("_target")
    ranked = codes.join(reached.hint("merge"), F.col("concept_id") == F.col("_of"), "left")
    best = F.min(F.struct("_invalid", F.col("target_id").isNull().alias("_open"), "concept_id", "target_id", "domain_id"))
    return ranked.groupBy("vocab", "code").agg(best.alias("_best")).select(
        "vocab", "code", F.col("_best.concept_id").alias("source_concept_id"),
        F.coalesce("_best.target_id", F.lit(NO_CONCEPT)).cast("bigint").alias("concept_id"),
        F.col("_best.domain_id").alias("domain_id"))


def map_to_standard(
    df: DataFrame, lookup: DataFrame, *, vocab: str = "vocab", code: str = "code", stage: Stage = lazily
) -> DataFrame:
    """Rows with ``source_concept_id`` and ``concept_id`` (0 without a match), and the concept's ``domain_id``.

    Only the distinct codes in use meet the lookup; once staged, their size is known before the rows are joined.
    """
    used = df.where(F.col(code).isNotNull() & F.col(vocab).isNotNull()).select(vocab, code).distinct()
    known = lookup.select(F.col("vocab").alias("_l_vocab"), F.col("code").alias("_l_code"), "source_concept_id", "concept_id", "domain_id")
    mapping = stage(used.join(known, (F.col(vocab) == F.col("_l_vocab")) & (F.col(code) == F.col("_l_code"))).select(
        F.col(vocab).alias("_m_vocab"), F.col(code).alias("_m_code"), "source_concept_id", "concept_id", "domain_id"))
    added = ("source_concept_id", "concept_id", "domain_id")
    kept = df.select(*[c for c in df.columns if c not in added])
    found = kept.join(mapping, (F.col(vocab) == F.col("_m_vocab")) & (F.col(code) == F.col("_m_code")), "left")
    none = F.lit(NO_CONCEPT).cast("bigint")
    return found.select(
        *kept.columns, F.coalesce("source_concept_id", none).alias("source_concept_id"),
        F.coalesce("concept_id", none).alias("concept_id"), "domain_id")


def code_entries(rows: DataFrame, lookup: DataFrame, vocabs: Sequence[str], stage: Stage = lazily) -> DataFrame:
    """``code, entries``: what the lookup knows of each code in use, under any of ``vocabs`` (one entry for each).

    So rows that are events of several vocabularies meet the lookup once.
    """
    used = rows.where(F.col("code").isNotNull()).select(F.col("code").alias("_used")).distinct()
    known = lookup.where(F.col("vocab").isin(*vocabs)).join(used, F.col("code") == F.col("_used"), "left_semi")
    entry = F.struct("vocab", "source_concept_id", "concept_id", "domain_id")
    return stage(known.groupBy("code").agg(F.collect_list(entry).alias("entries")))


def with_entry(events: DataFrame) -> DataFrame:
    """Events with the entry of their own vocabulary among ``entries``, as ``map_to_standard`` adds it."""
    none = F.lit(NO_CONCEPT).cast("bigint")
    own = F.get(F.filter("entries", lambda e: e["vocab"] == F.col("vocab")), F.lit(0))
    found = events.withColumn("_own", own)
    return found.select(
        *[c for c in events.columns if c != "entries"], F.coalesce("_own.source_concept_id", none).alias("source_concept_id"),
        F.coalesce("_own.concept_id", none).alias("concept_id"), F.col("_own.domain_id").alias("domain_id"))


def route_by_domain(events: DataFrame, *, target: str = "target") -> DataFrame:
    """Events whose ``target`` follows their concept's domain; without a concept, or of another domain, they stay."""
    routed = F.coalesce(*[F.when(F.col("domain_id") == d, F.lit(t)) for d, t in DOMAIN_TARGETS.items()], F.col(target))
    return events.withColumn(target, routed)
