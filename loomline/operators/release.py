"""The release gate, scenario packages and evaluation rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.intent import intent_label

# Categories that a scenario may have, and the checks that an evaluation row lists.
CATEGORIES = ("normal", "edge", "security", "recovery", "adversarial")
CHECKS = ("intent_aligned", "output_assertions_passed", "state_assertions_passed", "policy_checks_passed", "answer_faithful")


@dataclass(frozen=True)
class ReleasePolicy:
    min_accepted_rows: int = 100
    min_train_rows: int = 80
    min_validation_rows: int = 10
    min_failure_variants: int = 10
    require_expert_review: bool = True


def leaked(accepted: DataFrame, holdout: DataFrame) -> DataFrame:
    """Ids (id) that are both accepted and held out."""
    return accepted.select("id").distinct().join(holdout.select("id"), "id", "left_semi")


def reasons(policy: ReleasePolicy = ReleasePolicy()) -> Column:
    """What speaks against a release, in order, from one row of counts and facts."""
    review = F.lit(policy.require_expert_review) & (F.col("expert_decisions") <= 0)
    tests = (
        (F.col("n_leaked") > 0, "holdout leakage"),
        (~F.col("privacy_clean"), "privacy failure"),
        (~F.col("outcome_assertions"), "no outcome assertions"),
        (review, "no expert decisions"),
        (F.col("n_accepted") < policy.min_accepted_rows, "insufficient accepted rows"),
        (F.col("n_train") < policy.min_train_rows, "insufficient training rows"),
        (F.col("n_validation") < policy.min_validation_rows, "insufficient validation rows"),
        (F.col("n_failure_variants") < policy.min_failure_variants, "insufficient failure variants"),
    )
    return F.filter(F.array(*(F.when(test, reason) for test, reason in tests)), lambda x: x.isNotNull())


def assess_release(facts: DataFrame, policy: ReleasePolicy = ReleasePolicy()) -> DataFrame:
    """``facts`` with reasons and status. It has n_accepted, n_train, n_validation, n_failure_variants, n_leaked,
    expert_decisions, outcome_assertions and privacy_clean; ``released`` is the only success."""
    judged = facts.withColumn("reasons", reasons(policy))
    failed = (F.col("n_leaked") > 0) | ~F.col("privacy_clean")
    started = F.when(F.col("outcome_assertions"), "machine_verified").otherwise("generated")
    waiting = F.when(F.array_contains("reasons", "no expert decisions"), "awaiting_review").otherwise("accepted")
    status = F.when(failed, "failed").when(F.col("n_accepted") == 0, started).when(F.size("reasons") > 0, waiting).otherwise("released")
    return judged.withColumn("status", status)


def scenario_packages(rows: DataFrame) -> DataFrame:
    """Scenario packages of verified question-answer rows; what a row lacks has its default.

    The id is the row's scenario_id, else its chain's, else scenario-0; an unknown category is an error.
    """
    has = lambda name, other: F.coalesce(F.col(name), other) if name in rows.columns else other
    texts = F.array().cast("array<string>")
    category = has("category", F.lit("normal"))
    checked = F.when(category.isin(*CATEGORIES), category).otherwise(F.raise_error(F.concat(F.lit("unknown category: "), category))).cast(
        "string"
    )
    ran = has("verification.execution_completed", F.lit(False)) if "verification" in rows.columns else F.lit(False)
    evidence = [
        F.coalesce(F.col(f"verification.{name}"), F.lit(False)).alias(name) if "verification" in rows.columns else F.lit(False).alias(name) for name in (
            *CHECKS, "safe_to_review"
        )
    ]
    done = F.coalesce(F.col("verification.execution_completed"), F.lit(False)) if "verification" in rows.columns else ran
    return rows.select(
        F.coalesce(F.nullif(has("scenario_id", F.lit(None).cast("string")), F.lit("")), F.col("provenance.chain_id"), F.lit("scenario-0")).alias(
            "scenario_id"
        ),
        F.col("question").alias("intent"),
        F.coalesce(F.nullif(has("intent_type", F.lit(None).cast("string")), F.lit("")), intent_label(F.col("question"))).alias(
            "intent_type"
        ),
        checked.alias("category"),
        F.coalesce("entity_refs", texts).alias("entities"),
        has("business_rules", texts).alias("business_rules"),
        F.col("chain").alias("tool_chain"),
        "expected_outcomes",
        F.coalesce("answer_draft", F.lit("")).alias("expected_answer"),
        has("failure_mode", F.lit(None).cast("string")).alias("failure_mode"),
        F.struct(done.alias("execution_completed"), *evidence).alias("verification"),
        "provenance",
    )


def evaluation_rows(packages: DataFrame) -> DataFrame:
    """Rows of an evaluation set: what is asked, and which calls, outcomes and answer are expected."""
    calls = F.transform("tool_chain", lambda s: F.struct(s["tool"].alias("tool"), s["tool_input"].alias("arguments")))
    checks = F.struct(*(F.col(f"verification.{name}").alias(name) for name in CHECKS))
    truth = F.struct("intent_type", F.col("verification.safe_to_review").alias("verified"), checks.alias("checks"))
    return packages.select(
        "scenario_id", "category", "failure_mode", F.col("intent").alias("prompt"), "expected_answer", calls.alias("expected_tool_calls"),
        F.transform("expected_outcomes", lambda o: o["assertion"]).alias("expected_outcomes"), "business_rules", truth.alias("ground_truth"), "entities", "provenance",
    )
